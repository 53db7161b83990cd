import random
import zlib

import pyspark.sql.functions as F

from lograft.llm import toxicity as T


def test_fold():
    assert T.fold("1D10T, Ｃ1оwn!") .split() == ["idiot", "ciowni"]
    assert T.fold("Él pé​lo LOSER").split() == ["ei", "peio", "ioser"]


def test_hits_match_plain_search_and_exceptions():
    lex = T.Lexicon({"trash": 2.0, "idiot": 3.0}, ["trash can"])
    text = "a trash can, TR4SH; idiots atrash trash cannot"
    f = T.fold(text) + " "
    want = [(f.index(" trash", 10), 2.0)]
    got = [(s, w) for s, _, w in lex.hits(f)]
    assert len(got) == 3 and got[0] == want[0] and sorted(w for _, w in got) == [2.0, 2.0, 3.0]
    assert T.Lexicon({}, []).score("anything") == 0.0 and 0 < lex.score(text) < 1
    assert lex.score("idiot " + "word " * 10) > lex.score("idiot " + "word " * 1000) > 0


def corpus(n=600):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        w = [r.choice(words) for _ in range(r.randint(5, 400))]
        if toxic:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(["scumbag", "vileword", "V1LEWORD", "zzgrub" + r.choice(words)]))
        elif i % 100 == 1:
            w.insert(r.randrange(len(w)), "scumbag museum")
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic), 1))
    return rows, labels


def test_learns_and_holds_out(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(9001, "", "x"), (9002, None, "x"), (None, "vileword", "x"), (3, rows[3][1], "x")], "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(7, None, None), (None, 1, 0)], "doc_id long, toxic int, quality int")
    lex = T.learn(docs, lab)
    assert {"viieword", "zzgrub"} <= set(lex.entries) and any("museum" in x for x in lex.exceptions)
    got = T.score_texts(docs, lex).withColumn("h", T.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) + 4
    truth = {i: t for i, t, _ in labels}
    held = [(truth[r.doc_id], r.score >= 0.5) for r in got if r.doc_id in truth and r.h]
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(t == p for t, p in held) / len(held) >= 0.95
    assert [r.score for r in got if r.doc_id in (9001, 9002)] == [0.0, 0.0]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    lex = T.learn(docs, lab)
    assert lex.entries == {} and T.score_texts(docs, lex).count() == 0


def test_few_toxic_documents_short_words_and_rare_labels(spark):
    """Ten toxic documents, each word in four of them, one of three letters; the
    sample holds every toxic row among many clean ones."""
    assert T.support(10) == 3 and T.support(1000) == T.MIN_DOCS and T.shares(1000, 10, 100) == (90, 10) and T.shares(10, 1000, 100) == (10, 90)
    toxic = [f"{'zug' if i < 4 else 'vorbel'} filler{i} plain words number{i}" for i in range(10)]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % T.FOLDS]
    rows = [(k, toxic[n] if n < 10 else f"filler{k} plain words number{k}", int(n < 10)) for n, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lex = T.learn(df, df.select("doc_id", "toxic"), 200)
    assert "zug " in lex.entries and lex.score("the zug here") >= 0.5 and lex.score("the vorbel here") >= 0.5
    assert lex.score("the zugar here") == 0 and lex.score("plain words here") == 0
