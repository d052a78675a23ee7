"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its SHA-256. The ledger, a Parquet folder, has a row for each scan of
a blob: the rule versions that were applied and what they found. A scan takes the distinct blobs of its input,
drops the (blob, rule version) pairs that the ledger already has, scans the rest, appends one row a blob, and
joins the findings back to every path that holds the blob.

A row is appended only when its scan is done, so a job that fails midway leaves a ledger that is behind, never
one that claims too much; a pair scanned twice gives the same spans, which are read as a set.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.frames import stored, unused
from shelfline.session import run_dir


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of `pattern` whose `group` has `least` characters or more.

    `needs` lists strings of which a text with a match holds at least one: others aren't searched.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    needs: tuple[str, ...] = ()
    any_case: bool = False

    @property
    def version(self) -> str:
        told = "\0".join(map(str, (self.kind, self.pattern, self.least, self.group, self.any_case)))
        return f"{self.kind}-{hashlib.sha256(told.encode()).hexdigest()[:12]}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        if self.needs and not any(x in text for x in self.needs):
            return []
        found = re.compile(self.pattern, re.A | (re.I if self.any_case else 0)).finditer(text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


# The three base rules of the contract.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         12, 2, (":", "="), True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, needs=("AKIA",)),
    # Runs of the class are maximal, so a run of 16 or more is found at its start either way.
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
# From BEGIN to its END, if no other BEGIN comes before; else header lines and all base64 that follows: long runs,
# and lines of nothing else.
PEM = (
    r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?)-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1-----"
    r"|(?:\s*(?:Proc-Type|DEK-Info|Version|Comment): [^\n]*)*"
    r"(?:(?:\s|\\[nr])*(?:[A-Za-z0-9+/=]{20,}|(?:(?<=\n)|(?<=\\n))[A-Za-z0-9+/=]+(?=[ \t\r]*(?:\n|\Z)|\\[nr])))*)"
)
#: Well-known token formats that the base rules miss.
FURTHER = (
    Rule("pem", PEM, needs=("-----BEGIN ",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=("eyJ",)),
)
RULES = BASE + FURTHER

FINDINGS = "array<struct<kind:string,version:string,start:int,end:int>>"
LEDGER = f"blob string, versions array<string>, findings {FINDINGS}"


def _scanned(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows (blob, text, versions) to ledger rows."""
    by_version = {rule.version: rule for rule in rules}
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("version", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob, text, versions = (batch.column(batch.schema.get_field_index(c)) for c in ("blob", "text", "versions"))
            found = [
                [{"kind": by_version[v].kind, "version": v, "start": a, "end": b}
                 for v in wanted for a, b in by_version[v].spans(content)]
                for content, wanted in ((t.as_py(), w.as_py()) for t, w in zip(text, versions))
            ]
            yield pa.RecordBatch.from_arrays([blob, versions, pa.array(found, kinds)], ["blob", "versions", "findings"])

    return todo.mapInArrow(run, LEDGER)


#: The session setting that names the ledger's folder, which all executors reach.
LEDGER_SETTING = "spark.shelfline.secretLedger"


def ledger_of(spark: SparkSession) -> str:
    """The ledger that the session names, kept between runs, or else a new one."""
    return spark.conf.get(LEDGER_SETTING, None) or run_dir(spark, "secret-ledger")


def scan(df: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "findings") -> DataFrame:
    """Adds `out`, the findings of the current rules in each row's whole text, sorted by start and kind.

    `ledger` is a folder that all executors reach; it need not exist. Null texts count as empty and find
    nothing. Repeated rows and equal texts are scanned once and all get the findings. Other columns stay; one
    named like the result is replaced. An empty table gives an empty table.
    """
    spark = df.sparkSession
    versions = F.array(*[F.lit(rule.version) for rule in rules])
    address = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    blobs = df.select(address.alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    known = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    if known:
        # Of the ledger, only rows of the input's blobs are grouped.
        addresses = blobs.select("blob").distinct()
        seen = spark.read.schema(LEDGER).parquet(ledger).join(addresses, "blob", "left_semi").select(
            "blob", F.explode("versions").alias("version"))
        seen = seen.groupBy("blob").agg(F.collect_set("version").alias("seen"))
        # Which blobs have work left is decided on addresses alone; texts are dealt out for those only.
        left = addresses.join(seen, "blob", "left").select(
            "blob", F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>"))).alias("versions"))
        todo = blobs.dropDuplicates(["blob"]).join(left.filter(F.size("versions") > 0), "blob")
    else:
        todo = blobs.dropDuplicates(["blob"]).withColumn("versions", versions)
    _scanned(todo.select("blob", "text", "versions"), rules).write.mode("append").parquet(ledger)

    kinds = F.create_map(*[F.lit(x) for i, rule in enumerate(rules) for x in (rule.version, i)])
    rows = spark.read.schema(LEDGER).parquet(ledger).filter(F.size("findings") > 0)
    rows = rows.join(addresses, "blob", "left_semi") if known else rows
    own, named = unused(df, "_address", "_blob")
    current = (
        rows.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("all"))
        .select(F.col("blob").alias(named), F.array_sort(F.transform(
            F.filter(F.array_distinct("all"), lambda f: F.array_contains(versions, f["version"])),
            lambda f: F.struct(f["start"].alias("start"), kinds[f["version"]].alias("rule"), f["end"].alias("end"), f["kind"].alias("kind")),
        )).alias(out))
    )
    # Written first: the join then has plain tables on both sides, and a blob with very many paths can be split.
    current = stored(current, "findings")
    paths = df.drop(out).withColumn(own, address)
    joined = paths.join(current, F.col(own) == F.col(named), "left").drop(own, named)
    empty = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")
    return joined.withColumn(out, F.coalesce(out, empty))


def told(findings: Column) -> Column:
    """Findings as kind:start:end, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def masked(text: str | Column, findings: Column, mark: str = "<secret>") -> Column:
    """The text with every found span, overlaps as one, replaced by `mark`."""
    text = F.col(text) if isinstance(text, str) else text
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, f: Column) -> Column:
        new = f["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, f["start"] - state["at"])
        return F.struct(
            F.when(new, F.concat(state["done"], between, F.lit(mark))).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], f["end"]).alias("at"),
        )

    rest = lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(findings) > 0, F.aggregate(findings, start, step, rest)).otherwise(text)
