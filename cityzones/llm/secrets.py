"""Secret scan with an incremental blob ledger.

Every version of every path is content-addressed: ``versions`` are rows (path,
blob), a blob being the SHA-256 of its text.  The ledger remembers which (blob,
rule version) pairs were scanned and what was found.  A run reads only the
texts of unseen pairs, one row per distinct blob however many paths and
versions carry it, appends their findings, and joins the ledger back to all
paths.  A later run with the same ledger scans nothing twice; a new rule
version scans everything once more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cityzones.llm.common import materialize
from cityzones.session import scratch_path

RULE_VERSION = "2"

# The rules, in the order that breaks ties between spans with one start.  (kind, pattern, group whose
# length counts, least length).  Patterns see UTF-8 bytes, so only ASCII letters fold.
RULES = (
    ("assign", rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", rb"AKIA[A-Z0-9]+", 0, 18),
    ("hex", rb"[0-9a-f]{16,}", 0, 16),
    ("pem", rb"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    ("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("github", rb"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
)
BASE = ("assign", "access", "hex")
_FOLDED = {"assign"}
# A cheap sign that must be somewhere in the text (lower-cased for folded rules) for the pattern to match at all.
_SIGNS = {"access": (b"AKIA",), "pem": (b"PRIVATE KEY-----",), "jwt": (b"eyJ",), "github": (b"gh",),
          "assign": (b"passw", b"secret", b"token", b"api")}
_COMPILED = [(kind, re.compile(p, re.IGNORECASE if kind in _FOLDED else 0), group, least)
             for kind, p, group, least in RULES]
SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points by start, then rule order; leftmost and non-overlapping per kind."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    low = None
    found = []
    for rank, (kind, pattern, group, least) in enumerate(_COMPILED):
        if kind in _SIGNS:
            if kind in _FOLDED:
                low = raw.lower() if low is None else low
            if not any(s in (low if kind in _FOLDED else raw) for s in _SIGNS[kind]):
                continue
        for m in pattern.finditer(raw):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), rank, m.end(), kind))
    if not found:
        return []
    found.sort()
    if len(raw) == len(text):
        return [(kind, s, e) for s, _, e, kind in found]
    # code points before a byte: bytes that do not continue a character
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(kind, int(before[s]), int(before[e])) for s, _, e, kind in found]


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] for t in f["text"]]
        yield pd.DataFrame({"blob": f["blob"], "spans": spans})


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one when nothing was written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, ledger_path: str, path_col: str = "path", text_col: str = "text",
                  rule_version: str = RULE_VERSION) -> DataFrame:
    """Rows (path, blob, spans), one per row of ``versions``; appends unseen blobs to the ledger at ``ledger_path``.

    A null text is the empty blob.  Repeated versions come back once each.  Clean blobs have an empty array."""
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = versions.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    paths = materialize(blobs.select("path", "blob"), "secret-paths")
    seen = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob", "spans")
    fresh = blobs.groupBy("blob").agg(F.first("text").alias("text")).join(seen.select("blob"), "blob", "left_anti")
    (fresh.mapInPandas(_scan, f"blob string, spans {SPANS}")
     .select("blob", F.lit(rule_version).alias("rule_version"), "spans").write.mode("append").parquet(ledger_path))
    # a run that was repeated after a failure may have appended a blob twice
    now = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version)
    hits = now.where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    return paths.join(hits, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("path"), "text")
    found = scan_versions(docs, scratch_path(spark, "secret-ledger"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        F.col("path").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))




QUERIES = {"op10_secret_scan": op10_secret_scan}
ORACLE = {}
