import random

import numpy as np
import pytest

from lograft.llm import language_id as L

SYL = {"en": ["th", "er", "on", "an", "ing", "the", "sh"], "de": ["sch", "ein", "ung", "ö", "ß", "keit"], "es": ["ción", "ñ", "os", "ar", "que", "ll"]}


def text(r, lang, n):
    return " ".join("".join(r.choice(SYL[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def corpus(n=300):
    r = random.Random(1)
    rows = []
    for i in range(n):
        lang = r.choice(list(SYL))
        rows.append((i, text(r, lang, r.randint(3, 80)), lang, f"src{i % 5}"))
    return rows


def test_scores_match_plain_sum():
    r = np.random.default_rng(0)
    t = r.normal(size=(L.SLOTS, 3)).astype(np.float32)
    m = L.TextModel(["a", "b", "c"], t)
    bodies = [b"", b"x", b"Hello, World", "ñandú 12".encode(), b"long text " * 300_000, b"end"]
    for got, body in zip(m.scores(bodies), bodies):
        slots = L.trigram_slots(b" " + body + b" ")
        assert got == pytest.approx(t[slots].astype(float).sum(axis=0), rel=1e-4, abs=1e-3)


def test_rare_language_has_a_table(spark):
    """20 labelled rows among 3,000 are learned from, however small the sample."""
    r = random.Random(2)
    rows = [(i, text(r, "en", 20), "en") for i in range(3000)] + [(i, text(r, "es", 20), "es") for i in range(3000, 3020)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit_text_model(df, 40)
    assert model.langs == ["en", "es", "und"]
    fresh = [text(r, "es", 20).encode() for _ in range(20)]
    assert (model.scores(fresh).argmax(axis=1) == 1).all()
    kept = L._sample(df.selectExpr("doc_id as id", "lang"), 40).groupBy("lang").count().collect()
    assert {x["lang"]: x["count"] for x in kept} == {"en": 40, "es": 20}


def test_documents(spark):
    rows = corpus()
    odd = [(900, None, "en", "src0"), (901, "", "en", None), (902, "123 !!", None, "src1"), (903, "漢字仮名交じり文の文章です" * 8, None, "src1"), (None, text(random.Random(3), "es", 30), "es", "src2"), (3, rows[3][1], rows[3][2], "src3")]
    df = spark.createDataFrame([(*x, "n") for x in rows + odd], "doc_id long, text string, lang string, source string, host string")
    got = L.identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.id: r for r in got}
    right = [by[i].language == lang and by[i].accepted for i, _, lang, _ in rows]
    assert sum(right) / len(right) >= 0.98
    assert [by[i].accepted for i in (900, 901, 902, 903)] == [False] * 4 and by[None].language == "es"
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {i for (i, *_), ok in zip(rows, right) if ok} | {None}
    assert not {900, 901, 902, 903} & {r.doc_id for r in kept.collect()}
    assert L.identify(df.limit(0)).count() == 0


def test_fusion_lets_host_and_markup_decide_short_texts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    r = random.Random(5)
    pages = [(i, f"https://www.h{i % 3}.example.{'de' if i % 3 == 0 else 'org'}/x", f'<html lang="{l}"><script>var a = "the"</script><p>{text(r, l, 40)}</p></html>')
             for i in range(90) for l in [["de", "en", "es"][i % 3]]]
    pages += [(900, "https://www.h0.example.de/", "<html lang='de-AT'><p>on</p>"), (901, "https://www.h2.example.org/", "<p>a</p>"), (902, None, None), (903, "nonsense", "<b></b>")]
    ev = L.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {x.id: x for x in L.fuse(ev, L.fit_text_model(docs)).collect()}
    assert got[900].declared == "de" and got[900].language == "de" and got[900].text_language == "en"
    assert got[901].language == "es"
    assert not got[902].accepted and not got[903].accepted
    assert all(got[i].language == ["de", "en", "es"][i % 3] for i in range(90))


def test_slips_in_labels_add_no_language(spark):
    r = random.Random(8)
    rows = [(i, text(r, ["en", "es"][i % 2], 20), ["en", "es"][i % 2]) for i in range(60)]
    rows += [(100, text(r, "en", 9), "xx"), (101, text(r, "en", 9), "english"), (102, text(r, "en", 9), "eng lish")]
    rows += [(110 + i, text(r, "en", 9), "unknown") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.fit_text_model(df).langs == ["en", "es", "und"]
    assert L.fit_text_model(df.limit(0)).langs == ["und"]


def test_fusion_matches_plain_version(spark):
    """Every step of the evidence fusion, recomputed row by row."""
    r = random.Random(21)
    langs = list(SYL)
    train = [(i, text(r, langs[i % len(langs)], 30), langs[i % len(langs)]) for i in range(60)]
    model = L.fit_text_model(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    rows = []
    for i in range(80):
        lang = r.choice(langs)
        rows.append((i, text(r, lang, r.randint(0, 6)) if i % 9 else "123 ...", r.choice([None, lang, lang, "zz"]), r.choice([None, "org", lang]),
                     r.choice([None, f"a.{lang}.org", "b.x.org"]), r.choice([None, f"{lang}.org", "x.org"])))
    df = spark.createDataFrame([(i, bytearray((t or "").encode()), d, s, h, w) for i, t, d, s, h, w in rows],
                               "id long, body binary, declared string, suffix string, host string, site string")
    got = {x.id: x for x in L.fuse(df, model).collect()}

    n = len(model.langs)
    prior = np.log([1 - L.UND_PRIOR] * (n - 1) + [L.UND_PRIOR])
    ll = [L.TEMPER * sum((model.table[s].astype(float) for s in L.trigram_slots(b" " + t.encode() + b" ")), np.zeros(n)) for _, t, *_ in rows]
    p = [np.exp(x + prior - x.max()) for x in ll]
    p = [x / x.sum() for x in p]
    total = sum(p)
    overall = (total + 1) / (total.sum() + n)

    def sums(at):
        out = {}
        for row, q in zip(rows, p):
            if row[at] is not None:
                out[row[at]] = out.get(row[at], 0) + q
        return out

    by = {at: sums(at) for at in (2, 3, 4, 5)}
    for row, x, q in zip(rows, ll, p):
        score = x.copy()
        for at in (2, 3):
            if row[at] is not None:
                c = by[at][row[at]]
                score += np.log((c + L.SHRINK * c.sum() / total.sum() + 1e-9) / (total + L.SHRINK))
        level = overall
        for at in (5, 4):
            if row[at] is not None:
                less = np.maximum(by[at][row[at]] - q, 0)
                level = (less + L.SHRINK * level) / (less.sum() + L.SHRINK)
        score += np.log(level + 1e-12)
        post = 1 / np.exp(score - score.max()).sum()
        letters = any(c.isalpha() for c in row[1])
        g = got[row[0]]
        assert g.language == (model.langs[int(score.argmax())] if letters else "und")
        assert abs(g.posterior - post) < 1e-4
        assert g.text_language == (model.langs[int(q.argmax())] if letters else "und")
        assert g.accepted == (g.language != "und" and g.posterior >= L.ACCEPT)
