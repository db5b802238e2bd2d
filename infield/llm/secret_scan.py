"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text: a blob. The ledger says which blobs were scanned by
which rule, at which version of the rule, and what was found. A run scans only pairs of blobs and rule versions that the
ledger lacks, each blob in one copy, appends what it found, and joins findings back to all paths by address. So a new
version of a file costs its own text, a new rule costs one pass of that rule, and copies cost nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from infield.llm.common import pieces, shared_dir, short_batches, stored, tidy

#: Rows of (address, tag) that are broadcast, 40 bytes each: 10 MB with Spark's overhead. Beyond, the join shuffles.
MAX_BROADCAST_ROWS = 100_000
HOT = 1_000  #: an address that more than one in so many versions has is joined by broadcast: there are fewer than so many of these


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are secrets if ``group`` of them has ``least`` characters; ``version`` changes with any of these.

    Texts without any character of ``needs`` have no match, which the rule's pattern has to ensure.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: str = ""
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of the leftmost matches that don't overlap, in code points; a match that is too short still takes its place."""
        if self.needs and not any(c in text for c in self.needs):
            return []
        return [m.span() for m in re.compile(self.pattern, re.ASCII).finditer(text) if len(m[self.group]) >= self.least]


def either_case(word: str) -> str:
    """A pattern of the word with its letters in either case; classes search faster than a flag."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word)


#: Patterns of the base rules, in the order in which equal starts are listed.
BASE = (
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})" + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, ":="),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ with 24 and more
)
#: Public formats of credentials that the base rules don't know.
MORE = (
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("forge", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    Rule("login", r"://[^\s/:@\"'<>]{1,200}:([^\s/:@\"'<>]{3,200})@", 1, 3),
)
RULES = BASE + MORE
SPAN = "struct<rule:string,start:long,end:long>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def address(text: str) -> Column:
    """The SHA-256 of a text's bytes; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The rows of a ledger; a path at which nothing was written yet has none."""
    if path is not None:
        try:
            return spark.read.schema(LEDGER).parquet(path).select("blob", "rules", "spans")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], LEDGER)


def _scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of ``texts`` (blob, missing, _text): of each blob, the rules of ``missing`` are tried on the whole text."""
    short_batches(texts.sparkSession)
    by_name = {r.name: r for r in rules}

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, []
        for batch in pieces(iter(batches)):
            blobs, missing = batch.column("blob").to_pylist(), batch.column("missing").to_pylist()
            out = []
            for i, text in enumerate(batch.column("_text")):
                if (blobs[i], missing[i]) != last:  # repeated rows lie side by side
                    whole = text.as_py() or ""
                    found = [{"rule": name, "start": a, "end": b} for name in missing[i] for a, b in by_name[name].spans(whole)]
                    last = blobs[i], missing[i]
                out.append(found)
            columns = [batch.column("blob"), batch.column("missing"), pa.array(out, pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
            yield pa.RecordBatch.from_arrays(columns, names=["blob", "rules", "spans"])

    return texts.select("blob", "missing", "_text").mapInArrow(run, LEDGER)


def update(versions: DataFrame, addressed: DataFrame, ledger: DataFrame, path: str, rules: Sequence[Rule], text: str) -> DataFrame:
    """Scans what the ledger lacks, appends it to ``path``, and gives those rows: (blob, rules, spans), one a blob.

    ``addressed`` has blob and tag of every version, written already. Of the versions of a blob those with its least tag are
    read again; they are told from the others by a join that moves texts only where neither list of tags is short.
    """
    wanted = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
    blobs = addressed.groupBy("blob").agg(F.min("tag").alias("tag"), F.max("tag").alias("other"))
    todo = blobs.join(seen, "blob", "left").withColumn("missing", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("missing") > 0)
    todo = stored(todo.select("blob", "tag", "missing"))
    count, whole = todo.agg(F.count("*"), F.coalesce(F.min(F.size("missing") == len(rules)), F.lit(True))).head()
    if not count:
        return ledger.limit(0)
    texts = versions.select(F.col(text).alias("_text"), address(text).alias("blob"), _tag(versions, text).alias("tag"))
    if count <= MAX_BROADCAST_ROWS:
        texts = texts.join(F.broadcast(todo), ["blob", "tag"])
    else:
        # where every pair is missing, the copies are what is left out; they are fewer
        copies = stored(addressed.join(todo.select("blob", "tag"), ["blob", "tag"], "left_anti").distinct()) if whole else None
        if copies is not None and copies.count() <= MAX_BROADCAST_ROWS:
            texts = texts.join(F.broadcast(copies), ["blob", "tag"], "left_anti").withColumn("missing", wanted)
        else:
            texts = texts.join(todo.hint("merge"), ["blob", "tag"])
    # a version that is listed twice is scanned twice, with equal results
    made = _scan(texts, rules).groupBy("blob", "rules").agg(F.max("spans").alias("spans"))
    at = f"{path}/run={uuid.uuid4().hex}"
    made.write.parquet(at)
    return versions.sparkSession.read.schema(LEDGER).parquet(at)


def _tag(versions: DataFrame, text: str) -> Column:
    """A number by the other columns of a version; equal numbers of different versions only cost a scan."""
    return F.xxhash64(F.lit(0), *[F.col(c) for c in versions.columns if c != text])


def scan_versions(versions: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``versions`` without their text, with blob (hex) and spans (rule, start, end; by start, then by the order of the rules).

    A row is a version of a path; its other columns name it (path, commit and so on) and need not be unique. The ledger at
    ``ledger_path`` is read and appended to; without a path it is begun anew in the shared folder. Null texts are empty ones,
    and have no findings. Texts are scanned whole. An empty table has an empty result, and appends nothing. Columns called
    blob or spans are replaced by the scan's, others stay. A run that fails before its end leaves the ledger as it was, or with whole rows that are right.
    """
    spark = versions.sparkSession
    versions = versions.drop("blob", "spans")
    names = [c for c in versions.columns if c != text]
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("a rule is there in two versions")
    path = ledger_path or f"{shared_dir(spark)}/infield-ledger-{uuid.uuid4().hex}"
    addressed = stored(versions.select(*names, address(text).alias("blob"), _tag(versions, text).alias("_secret_tag")))
    known = read_ledger(spark, ledger_path)
    new = update(versions, addressed.select("blob", F.col("_secret_tag").alias("tag")), known, path, rules, text)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    current = F.filter("spans", lambda s: s["rule"].isin([r.name for r in rules]))
    found = known.unionByName(new).withColumn("spans", current).where(F.size("spans") > 0)
    # an older run and this one may each have some rules' spans of a blob, never the same rule's twice
    found = found.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    found = stored(found.withColumn("spans", F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["rule"]].alias("at"), s["rule"].alias("rule"), s["end"].alias("end"))))))
    rows = addressed.drop("_secret_tag")
    total = rows.count()
    hot = rows.groupBy("blob").count().where(F.col("count") > max(total // HOT, 1)).join(found, "blob", "left").select("blob", "spans", F.lit(True).alias("_hot"))
    hot = stored(hot)
    cold = rows.join(F.broadcast(hot.select("blob")), "blob", "left_anti").join(found, "blob", "left")
    warm = rows.join(F.broadcast(hot.drop("_hot")), "blob")
    spans = F.transform(F.coalesce("spans", F.array().cast("array<struct<start:long,at:int,rule:string,end:long>>")), lambda s: F.struct(F.split_part(s["rule"], F.lit("@"), F.lit(1)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return cold.unionByName(warm).select(*names, F.lower(F.hex("blob")).alias("blob"), spans.alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
