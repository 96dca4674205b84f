"""Secret scans over an incremental blob ledger. DataFrame functions only.

Every version of a text is content-addressed by its SHA-256 (a blob). The ledger has a row for each
(blob, rules version) that was scanned, with what was found there. A scan takes the blobs that the
ledger lacks for its rules version, each once however many paths hold it, adds them to the ledger,
and joins findings back to every path. A second scan of the same texts scans none.

``scan_history`` takes versions commit by commit: each commit is scanned against the ledger of those before it, so a blob
that came in an earlier commit is not scanned again, and findings are joined to the paths of all commits. Query op3
reads its table as a history of ``COMMITS`` commits, dealt by a hash of the id.

Spans are found from the pieces between matches: the lengths of pieces and matches before a match
sum to its start, so one split and one extraction per rule give all positions, in code points.

Defined results: a null text is the empty text; repeated rows and equal texts share a blob and its
findings; a blob that a third of all paths hold is reduced before it shuffles, and the join back
sends only (path, blob) pairs, which Spark can split when they are skewed. An empty table gives no rows; a text of any
length is scanned whole; columns but the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose ``group`` is shorter than ``least`` are dropped; ``hint`` must occur in a text for the rule to be tried."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str


#: Base rules first, in the order that breaks ties of spans; the further ones only add spans.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, r"(?i:passw|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN [A-Z ]*PRIVATE KEY"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]+", 0, 36, r"gh[pousr]_[A-Za-z0-9]{30}"),
    Rule("web", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, r"\.eyJ"),
)
BASE = ("assign", "access", "hex")
VERSION = "1"
#: Commits in which query op3 reads its table.
COMMITS = 2
LEDGER = "blob string, version string, spans array<struct<start: bigint, ord: int, kind: string, end: bigint>>"


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, text) -> (blob, spans: array<struct<start, ord, kind, end>> by start, then rule order), one row per blob."""
    text = F.col("text")

    def tried(i: int, rule: Rule):
        whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
        lengths = lambda a: F.transform(a, lambda x: F.char_length(x))
        # the pieces carry no text along: lengths are all that a span needs
        found = F.struct(
            F.lit(i).alias("ord"),
            F.arrays_zip(lengths(F.split(text, rule.pattern, -1)).alias("gap"), lengths(whole).alias("n"), lengths(part).alias("tested")).alias("m"),
        )
        return F.when(text.rlike(rule.hint), found)

    tries = F.array_compact(F.array(*[tried(i, rule) for i, rule in enumerate(rules)]))
    hits = blobs.select("blob", F.explode(tries).alias("h")).select("blob", "h.ord", F.posexplode("h.m").alias("at", "m"))
    before = Window.partitionBy("blob", "ord").orderBy("at")
    end = F.sum(F.col("m.gap") + F.coalesce(F.col("m.n"), F.lit(0))).over(before)
    spans = hits.select("blob", "ord", "m.n", "m.tested", end.cast("long").alias("end"))
    least = F.element_at(F.array(*[F.lit(rule.least) for rule in rules]), F.col("ord") + 1)
    kind = F.element_at(F.array(*[F.lit(rule.kind) for rule in rules]), F.col("ord") + 1)
    spans = spans.where(F.col("n").isNotNull() & (F.col("tested") >= least))
    span = F.struct((F.col("end") - F.col("n")).alias("start"), "ord", kind.alias("kind"), "end")
    return spans.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES, version: str = VERSION) -> tuple[DataFrame, DataFrame]:
    """``versions`` (path, text) -> (path, blob, spans), and the ledger (blob, version, spans) with what was new.

    ``spans`` is null where a blob has none. What is new is written once, in the shared folder.
    """
    found, grown = scan_history([versions], ledger, rules, version)
    return found, grown


def scan_history(commits: list[DataFrame], ledger: DataFrame | None = None, rules=RULES, version: str = VERSION) -> tuple[DataFrame, DataFrame]:
    """As ``scan``, for commits in order: each is scanned only for pairs of blob and rules version that neither the ledger nor an earlier commit has."""
    ledger = commits[0].sparkSession.createDataFrame([], LEDGER) if ledger is None else ledger.select("blob", "version", "spans")
    paths = []
    for versions in commits:
        text = F.coalesce("text", F.lit(""))
        addressed = versions.select("path", F.sha2(text, 256).alias("blob"), text.alias("text"))
        seen = ledger.where(F.col("version") == version).select("blob")
        # each blob once before anything is joined, so that copies never meet
        blobs = addressed.groupBy("blob").agg(F.any_value("text").alias("text")).join(seen, "blob", "left_anti")
        unseen = addressed.select("blob").distinct().join(seen, "blob", "left_anti")
        new = unseen.join(scan_blobs(blobs, rules), "blob", "left").select("blob", F.lit(version).alias("version"), "spans")
        ledger = ledger.unionByName(written(new))
        paths.append(addressed.select("path", "blob"))
    known = ledger.where((F.col("version") == version) & F.col("spans").isNotNull()).select("blob", "spans")
    every = reduce(DataFrame.unionByName, paths)
    return every.join(known, "blob", "left").select("path", "blob", "spans"), ledger


def joined(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans, comma-joined; of some kinds only, if given."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    texts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(texts, ","), F.lit(""))


def secret_rows(docs: DataFrame, ledger: DataFrame | None = None, commits: int = COMMITS) -> DataFrame:
    """The rows of query op3: its table, commit by commit."""
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    at = F.pmod(F.crc32(F.coalesce(F.col("path").cast("string"), F.lit("")).cast("binary")), F.lit(commits))
    found, _ = scan_history([versions.where(at == k) for k in range(commits)], ledger)
    count = lambda kind: F.when(F.col("spans").isNull(), 0).otherwise(F.size(F.filter("spans", lambda s: s["kind"] == kind))).cast("long")
    return found.select(
        F.col("path").alias("doc_id"), *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(F.col("spans"), BASE), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
