"""Benchmark: headline operators over whole tables, one JSON line.

Inputs (log lines, text lines, messages) are written as tables before the
clock starts, so a time is the time of the operator itself; `rows_per_s` counts
its input rows. Each query is forced with a no-op write (full evaluation,
nothing collected to the driver).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lograft import schemas as S  # noqa: E402
from lograft.functions.mask import mask_text  # noqa: E402
from lograft.operators import decode as D  # noqa: E402
from lograft.operators import enrich as EN  # noqa: E402
from lograft.operators import flatten as FL  # noqa: E402
from lograft.operators import pipeline as PL  # noqa: E402
from lograft.operators import recombine as RC  # noqa: E402
from lograft.plans import container_lines as C  # noqa: E402
from lograft.plans import lookups as LK  # noqa: E402
from lograft.plans import queries as Q  # noqa: E402
from lograft.plans import text_lines as T  # noqa: E402
from lograft.plans.tables import table  # noqa: E402
from lograft.session import build_session  # noqa: E402
from lograft.sinks.files import land  # noqa: E402
from lograft.sources import textlogs as TL  # noqa: E402


def cases(spark, d):
    """name -> (landed input, input -> DataFrame)."""
    ev, docs = table(spark, d, "events", spread=True), table(spark, d, "documents", spread=True)
    lines = Q.log_lines(spark, d)
    accounts = Q._accounts_lines(spark, d)
    registry = D.registry_lookup(S.registry(spark))
    routed = lambda x: D.decode(x, registry)
    addresses = land(ev.select("event_id", LK.geo_address(F.col("event_id"), F.col("user_id")).alias("ip_address")), "addresses")
    lookups = Q._lookups(spark, d)
    geo = EN.prepare_ranges(LK.geo_ranges(table(spark, d, "nation"), table(spark, d, "region")), EN.GEO_COLUMNS)
    isp = EN.prepare_ranges(LK.isp_ranges(table(spark, d, "supplier")), EN.ISP_COLUMNS)
    yield "decode_events", lines, lambda x: D.decoded(routed(x))
    yield "decode_errors", lines, lambda x: D.errors(routed(x))
    yield "decode_enriched", lines, lambda x: D.decoded(PL.decode_pipeline(x, lookups, received_col="received"))
    yield "accounts_events", accounts, lambda x: FL.flatten_metrics(D.decoded(routed(x)), {"string": ["account.user_id_sha256", "event.name", "relying_party.service"]})
    yield "explode_events", lines, lambda x: FL.explode_events(D.decoded(routed(x)).select("document_id", "events"), extras=("object_type", "object_state", "linking"))
    yield "mask_documents", land(docs.select("doc_id", "text"), "docs"), lambda x: x.select("doc_id", mask_text("text").alias("text"))
    yield "parse_mixed", land(T.events_to_text_lines(ev, "mixed"), "mixed"), \
        lambda x: x.select("event_id", TL.parse_by_format(F.col("value"), F.col("format"), year=F.col("year")).alias("p")).select("event_id", "p.*")
    yield "recombine_lines", land(C.documents_to_container_lines(docs), "container"), lambda x: RC.recombine_lines(TL.parse_docker(x), "file_path", "n", "log")
    yield "geo_country", addresses, lambda x: EN.scrub_address(EN.enrich_geo(x, geo, cities=lookups.cities))
    yield "isp", addresses, lambda x: EN.scrub_address(EN.enrich_isp(x, isp))
    pods = LK.pods_of(table(spark, d, "nation"))
    files = land(ev.select(C.file_path_of(F.col("event_id")).alias("file_path"), F.col("props").alias("log")), "pod-files")
    yield "pod_metadata", files, lambda x: EN.merge_log(EN.enrich_pods(x, pods), "log")


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # Warm the JVM (class loading, JIT, codegen caches) on the smallest scale.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for _, given, f in cases(spark, warm_dir):
            force(f(given))
    times, rate = {}, {}
    for name, given, f in cases(spark, sf_dir):
        n = given.count()
        t0 = time.time()
        force(f(given))
        times[name] = round(time.time() - t0, 3)
        rate[name] = round(n / max(times[name], 1e-3))
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows_per_s": rate, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
