import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from lograft.llm import piece_viterbi as V

PATH = public_tokenizers.path(V.MODEL)


def texts(seed, n):
    r = random.Random(seed)
    syl = ["th", "er", "on", "ión", "é", "ß", "ing", "tion", "ha", "ö", "qu", "a", "lo", "we", "1", "23", ".", ",", "!", "http", "://", "Ab", "C"]
    out = []
    for _ in range(n):
        sep = r.choice([" ", " ", "  ", "\n", " " * r.randint(1, 40)])
        out.append(sep.join("".join(r.choice(syl) for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 30))))
    return out


HARD = ["", " ", "   ", "a", " a", "a ", "  Hello  world\n\tfoo  ", "ﬁ é 中文字 \U0001f600", "x 　y", "a" * 500, "ab" * 300, " " * 333, " " * 33 + "ﬁ", "<s> </s> <0x41> <unk>", "'s don't 123456 -- ###", "é ́"]


def test_ids_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    m = V.Model(PATH)
    some = HARD + texts(1, 400)
    for t, got in zip(some, m.encode(pa.array(some))):
        ids = np.frombuffer(got, "<i4").tolist()
        assert ids == sp.encode(t), t[:80]
        assert m.decode(got) == t == sp.decode(ids)


def test_stable_pairs_follow_the_merges():
    m, r = V.Model(PATH), random.Random(0)
    some = sorted(p for p in m.whole if set(p) != {"▁"})
    for _ in range(20_000):
        a, b = r.choice(some), r.choice(some).lstrip("▁") or "a"
        if b in m.whole:
            assert m.stable(a, b) == (m.merge(a + b) == [a, b]), (a, b)


def test_unigram_scores_equal_the_library(tmp_path):
    p = pb.ModelProto()
    p.ParseFromString(open(PATH, "rb").read())
    p.trainer_spec.model_type = V.UNIGRAM
    for x in p.pieces:
        x.score = min(-1.0, x.score / 1000) if x.type == V.NORMAL else x.score
    path = tmp_path / "u.model"
    path.write_bytes(p.SerializeToString())
    sp, m = sentencepiece.SentencePieceProcessor(model_file=str(path)), V.Model(str(path))
    for t in texts(2, 60):
        t = " ".join(t.split())
        ids = np.frombuffer(m.encode(pa.array([t]))[0], "<i4").tolist()
        score = lambda x: sum(p.pieces[i].score for i in x)
        assert m.decode(m.encode(pa.array([t]))[0]) == t and score(ids) == pytest.approx(score(sp.encode(t)), abs=1e-3)


def test_operator(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    some = [None, *HARD, *texts(3, 50), "mark ▁ inside"]
    rows = [(i % 40, t, "x") for i, t in enumerate(some)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = sorted(tuple(r) for r in V.piece_digest(df, PATH).collect())
    want = sorted((i, len(x := sp.encode(t or "")), zlib.crc32(np.array(x, "<i4").tobytes()), "▁" not in (t or "")) for i, t, _ in rows)
    assert got == want
    back = V.decode_pieces(V.encode_pieces(df, PATH), PATH)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((i, (t or "").replace("▁", " ")) for i, t, _ in rows)
    assert V.piece_digest(df.limit(0), PATH).count() == 0
