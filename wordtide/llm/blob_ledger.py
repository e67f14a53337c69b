"""Secret scans over an incremental ledger of blobs.

A *version* is a text at a path; its *blob* is the SHA-256 of the text's UTF-8 bytes. A *rule* is a kind of secret with
a version number. The ledger holds what was scanned: per blob the rules that have seen it, ``kind@version``, and what
they found. ``scan`` takes versions, reduces them to distinct blobs, drops the pairs of blob and rule that the ledger
already has, and scans the rest; ``by_path`` joins findings back to every path. So a text is scanned once however many
paths and historical versions hold it; a second run over the same history scans nothing; and a rule with a new number
scans every blob again, but no other rule does.

Copies meet as partial aggregates (a task sends one row per blob that it holds), and the ledger is joined on the
same partitioning, so texts are shuffled once. In ``by_path`` blobs that many paths hold are salted: they are found by a count over all
versions, there are at most ``HOT_BLOBS`` of them whatever the size of the input, and only their ids are broadcast.

Defined results: a null text is an empty one; a null path is an ordinary path; repeated rows are separate versions;
equal texts have equal findings; spans are code points, end exclusive; a text without findings has an empty list; an
empty table gives no rows; columns other than path and text are not read. Base rules (``assign``, ``access``,
``hex``) give leftmost matches that do not overlap within the rule; matches that fail a rule's check are dropped
and not tried again. Further rules add spans of kinds of their own and never touch those of others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

HOT_BLOBS, LEAST_HOT = 10_000, 1024


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``number`` goes up whenever pattern or check change."""

    kind: str
    number: int
    pattern: re.Pattern
    check: Callable[[re.Match], bool] = lambda m: True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.number}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.pattern.finditer(text) if self.check(m)]


def _long(n: int, group: int = 0) -> Callable[[re.Match], bool]:
    return lambda m: len(m[group]) >= n


def _mixed(m: re.Match) -> bool:
    """Capitals, small letters and three digits, spread like random characters."""
    text = m[0]
    counts = Counter(text)
    digits = sum(counts[d] for d in "0123456789")
    if digits < 3 or text.lower() == text or text.upper() == text:
        return False
    return -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values()) >= 4.0


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Base rules, in the order of their kinds.
BASE = (
    Rule("assign", 1, re.compile(_ASSIGN, re.ASCII | re.IGNORECASE), _long(6, 2)),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]+"), _long(20)),
    Rule("hex", 1, re.compile(r"[0-9a-f]+"), _long(24)),
)
#: Further rules. Each is linear: a match starts at a mark or at the start of a token only.
ADDED = (
    Rule("private_key", 1, re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z0-9 ]*PRIVATE KEY-----)?")),
    Rule("forge_token", 1, re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})")),
    Rule("chat_token", 1, re.compile(r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{10,}")),
    Rule("map_key", 1, re.compile(r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])")),
    Rule("web_token", 1, re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    Rule("bearer", 1, re.compile(r"(?<![A-Za-z0-9])[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*")),
    Rule("url_login", 1, re.compile(r"://[^\s/:@]+:[^\s/@]+@")),
    Rule("random", 1, re.compile(r"[A-Za-z0-9+/_=-]+"), lambda m: len(m[0]) >= 32 and _mixed(m)),
)
RULES = (*BASE, *ADDED)

_FOUND = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"
LEDGER = f"blob string, rules array<string>, found {_FOUND}"
_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("stop", pa.int64())])
_ROWS_A_BATCH = 1024


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _scan(rules: tuple[Rule, ...]):
    ranked = {r.name: (k, r) for k, r in enumerate(rules)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_A_BATCH):
                part = batch.slice(at, _ROWS_A_BATCH)
                found = []
                for text, pending in zip(part.column("text"), part.column("rules"), strict=True):
                    text = text.as_py()
                    hits = [(s, *ranked[name], e) for name in pending.as_py() for s, e in ranked[name][1].spans(text)]
                    hits.sort(key=lambda h: h[:2])
                    found.append([{"start": s, "rank": k, "kind": r.kind, "stop": e} for s, k, r, e in hits])
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), part.column("rules"), pa.array(found, pa.list_(_SPAN))], names=["blob", "rules", "found"]
                )

    return run


def scan(versions: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows ``LEDGER`` for ``versions(text)``: unseen pairs of blob and rule only, one row a blob.

    The rows are a written table; append them to ``ledger`` (``union``) for the next run.
    """
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", content_address(F.col("text")))
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        todo = blobs.select("blob", "text", names.alias("rules"))
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
        left = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen.hint("shuffle_hash"), "blob", "left").select("blob", "text", left.alias("rules")).where(F.size("rules") > 0)
    return materialise(todo.mapInArrow(_scan(tuple(rules)), LEDGER), "blob-scans")


def current(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found): of each blob that has any, the findings of these very rules, in order; older rule numbers do not count.

    The rows of a blob are as many as the runs that scanned it, each with other rules.
    """
    ranks = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))])
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.transform(F.array_intersect("rules", names), lambda n: F.substring_index(n, "@", 1))
    mine = ledger.select("blob", kinds.alias("kinds"), "found").select("blob", F.filter("found", lambda f: F.array_contains("kinds", f["kind"])).alias("found"))
    ranked = F.transform("found", lambda f: F.struct(f["start"].alias("start"), ranks[f["kind"]].alias("rank"), f["kind"].alias("kind"), f["stop"].alias("stop")))
    return mine.where(F.size("found") > 0).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(ranked)))).alias("found"))


def by_path(versions: DataFrame, findings: DataFrame, path: str = "doc_id") -> DataFrame:
    """(path, blob, and the columns of ``findings(blob, ...)``) for every version; nulls where its blob has no finding."""
    held = materialise(versions.select(path, content_address(F.col("text")).alias("blob")), "blob-versions")
    unit = F.lit(max(LEAST_HOT, held.count() // HOT_BLOBS))
    hot = held.groupBy("blob").count().where(F.col("count") > unit).select(F.col("blob").alias("hot_blob"), F.ceil(F.col("count") / unit).cast("int").alias("salts"))
    hot = F.broadcast(materialise(hot, "blob-hot", 1))
    salted = held.join(hot, F.col("blob") == F.col("hot_blob"), "left").select(
        path, "blob", F.when(F.col("salts").isNotNull(), (F.monotonically_increasing_id() % F.col("salts")).cast("int")).otherwise(0).alias("salt")
    )
    spread = findings.join(hot, F.col("blob") == F.col("hot_blob"), "left").drop("hot_blob")
    spread = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return salted.join(spread, ["blob", "salt"], "left").select(path, "blob", *[c for c in findings.columns if c != "blob"])


def listed(found: Column) -> Column:
    """Findings as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")


def find(docs: DataFrame, ledger: DataFrame | None = None, path: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version: (path, n_assign, n_access, n_hex, base_sha256, spans), from the ledger and a scan of what it lacks."""
    new = scan(docs, rules, ledger)
    found = current(new if ledger is None else new.unionByName(ledger), rules)
    base = F.filter("found", lambda f: F.array_contains(F.array(*[F.lit(r.kind) for r in BASE]), f["kind"]))
    counts = [_count_of(r.kind).alias(f"n_{r.kind}") for r in BASE]
    per_blob = found.select("blob", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
    out = by_path(docs, per_blob, path)
    none = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in BASE]
    return out.select(path, *none, F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
