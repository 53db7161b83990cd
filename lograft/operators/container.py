"""The container path as one function (S2-S4, F4, M1-M4, J1, J2, J9): lines of
container log files -> whole messages with pod metadata, masked before the
JSON in them is parsed, so no parsed value is ever clear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mask import mask_columns
from ..sinks.files import land
from ..sources import logs as SRC
from ..sources import textlogs as TL
from . import enrich as EN
from .joins import Lookup
from .recombine import recombine_lines


def container_logs(lines: DataFrame, pods: DataFrame | Lookup, *, tag_glob: str = "kube.*", labels: dict[str, str] | None = None,
                   max_bytes: int = SRC.MAX_LINE_BYTES) -> DataFrame:
    """`lines` (value, file_path) -> file_path, tag, first_order (ns), log,
    log_processed, parts, piece, pod columns and labels. Lines over `max_bytes`
    and files outside `tag_glob` are left out; a message of several pieces is
    not parsed as JSON."""
    x = SRC.drop_long_lines(lines.select("value", "file_path"), max_bytes)
    x = EN.route_by_tag(x.withColumn("tag", EN.tag_of("file_path")), tag_glob).drop("tag")
    # recombining reads them three times
    x = land(TL.parse_docker(x).select("file_path", "n", "log"), "container-records")
    x = recombine_lines(x, "file_path", "n", "log").withColumnRenamed("message", "log")
    x = mask_columns(x, ["log"])
    x = EN.merge_log(x, "log")
    x = EN.enrich_pods(x, pods).withColumn("tag", EN.tag_of("file_path"))
    return EN.add_labels(x, labels or {})
