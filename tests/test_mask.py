import re

from lograft.functions.mask import RULES, mask_text

CASES = [
    ("error happened with social security number 111-22-3333", "error happened with social security number xxx-xx-xxxx"),
    ("Something happened..with social 222-33-4444", "Something happened..with social xxx-xx-xxxx"),
    ("Processing credit card 1234 5678 9012 3456", "Processing credit card xxxx xxxx xxxx xxxx"),
    ("Users email is john.doe@example.com", "Users email is user@email.tld"),
    ("222--33---4444", "xxx-xx-xxxx"),
    ("9111-22-33334", "9xxx-xx-xxxx4"),
    ("12345678901234567", "xxxx xxxx xxxx xxxx7"),
    ("1234-5678-9012-3456", "1234-5678-9012-3456"),
    ("a@b.c", "a@b.c"),
    ("a@b.co1x@c.de", "user@email.tlduser@email.tld"),
    (None, None),
]


def test_mask_fixtures(spark):
    df = spark.createDataFrame([(a,) for a, _ in CASES], "log string")
    got = [r.m for r in df.select(mask_text("log").alias("m")).collect()]
    assert got == [b for _, b in CASES]


def test_no_pattern_left_after_masking(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.m for r in docs.select(mask_text("text").alias("m")).collect()]
    ssn, card = RULES[0][0], RULES[1][0]
    assert not any(re.search(ssn, t) or re.search(card, t) for t in texts if t)


def test_masking_twice_differs(spark):
    df = spark.createDataFrame([("a@b.co1x@c.de",)], "log string")
    once = df.select(mask_text("log").alias("log"))
    twice = once.select(mask_text("log").alias("log")).first().log
    assert twice != once.first().log
