"""W1 beyond a stream's horizon: messages delivered again days later, or under
another checkpoint, are recognised by an index of the ids already taken.

The index is two tables of a store, committed together with the rows they stand
for (a replayed batch adds nothing, a failed one leaves nothing):

- `ids`: the ids by the day of their message;
- `filters`: per commit and day a Bloom filter, cut into pieces of 32,768 bits.
  All bits of an id are in the one piece that its hash names, so probing is an
  equi-join on (pieces, piece). Pieces are aggregated by partial bitmaps; there are
  16 bits an id and PROBES bits set, so about one new id in 400 hits a day by chance.

A batch first probes the filters. Only the days whose filters hit are read, and
only ids that hit take part in the exact anti-join; a filter never decides.

Messages without id cannot be recognised: each is taken. Of messages in one
batch that share an id one is taken. Two streams may share an index if their
batches do not overlap in time; overlapping ones may both take a message.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import drop, land
from ..sinks.store import Store

PIECE = 1 << 15       # bits of a bitmap in Spark's bitmap functions
BITS = 16             # bits an id
PROBES = 4
NO_DAY = "none"       # day of messages without time


def _piece(id_col: str, pieces: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("piece"), id_col), pieces).cast("int")


def _positions(id_col: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(f"bit {i}"), id_col), F.lit(PIECE)).cast("int") for i in range(PROBES)]


def _is_set(bits: Column, position: Column) -> Column:
    at = (F.floor(position / 8) + 1).cast("int")
    byte = F.conv(F.hex(F.substring(bits, at, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)).cast("int") % 2 == 1


class SeenIds:
    """An index below `base`; `table` holds the rows taken."""

    def __init__(self, spark: SparkSession, base: str, table: str = "messages"):
        self.spark, self.table, self.store = spark, table, Store(spark, base)

    def filters_of(self, ids: DataFrame) -> DataFrame:
        """(day, pieces, piece, bits) of rows (id, day)."""
        pieces = 1
        need = ids.count() * BITS
        while pieces * PIECE < need:      # a power of two: few different numbers of pieces
            pieces *= 2
        x = ids.select("day", F.lit(pieces).alias("pieces"), _piece("id", F.lit(pieces)).alias("piece"), F.explode(F.array(*_positions("id"))).alias("at"))
        return x.groupBy("day", "pieces", "piece").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))

    def hits(self, ids: DataFrame, at: int) -> DataFrame:
        """(id, day): days whose filters may hold the id."""
        filters = self.store.read("filters", at)
        sizes = [r[0] for r in filters.select("pieces").distinct().collect()]      # powers of two
        probes = ids.select("id", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<int>")).alias("pieces"))
        probes = probes.withColumn("piece", _piece("id", F.col("pieces")))
        both = probes.join(filters, ["pieces", "piece"])
        return both.filter(reduce(Column.__and__, [_is_set(F.col("bits"), p) for p in _positions("id")])).select("id", "day").distinct()

    def known(self, ids: DataFrame, at: int) -> DataFrame | None:
        """(id) of those ids that the index holds; None if no filter hits."""
        hits = land(self.hits(ids, at), "hits")
        days = sorted(r[0] for r in hits.select("day").distinct().collect())        # one value a day kept
        if not days:
            return None
        taken = reduce(DataFrame.unionByName, [self.store.read("ids", at, day=d) for d in days])
        return taken.join(hits, ["id", "day"], "left_semi").select("id").distinct()

    def unseen(self, messages: DataFrame, id_col: str = "message_id") -> DataFrame:
        """Messages whose id is new, one for each id; those without id too."""
        once = messages.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        anonymous = messages.filter(F.col(id_col).isNull())
        state = self.store.state()
        if "ids" in state.schemas:
            known = self.known(once.select(F.col(id_col).cast("string").alias("id")), state.version)
            if known is not None:
                once = once.join(known, F.col(id_col).cast("string") == known["id"], "left_anti")
        return once.unionByName(anonymous)

    def take(self, messages: DataFrame, stream: tuple[str, int], id_col: str = "message_id", time_col: str = "publish_time") -> None:
        """Add the unseen ones of a batch to the table and the index in one commit.
        `stream` is the stream's name and the batch's number."""
        if self.store.done(*stream):
            return
        batch = land(messages, "batch")
        fresh = land(self.unseen(batch, id_col), "fresh")
        day = F.coalesce(F.date_format(F.col(time_col).cast("timestamp"), "yyyy-MM-dd"), F.lit(NO_DAY))
        ids = fresh.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), day.alias("day"))
        try:
            self.store.put({self.table: (fresh, []), "ids": (ids, ["day"]), "filters": (self.filters_of(ids), [])}, stream=stream)
        finally:
            drop(fresh)
            drop(batch)

    def read(self) -> DataFrame:
        return self.store.read(self.table)
