"""Document quality rules with verdicts on hosts.

Every document is measured by DataFrame expressions inside its own row, so no window of words is
ever shuffled. Failures are then summed per host, each host's rate is shrunk towards a beta prior
fitted to all hosts, and the verdict goes back to the host's documents: in a host where a rule fails
for most documents, a document that itself fails any rule is rejected too. A document that fails no
rule is kept wherever it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import null_safe_join, stage
from tillwise.llm.common import SPACES, let, space_words

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PCT = 30
MAX_SYMBOLS_PCT = 10  # symbols per 100 words
MAX_DUPLICATE_LINES_PCT = 30
MIN_MEAN_LENGTH, MAX_MEAN_LENGTH = 2, 15  # characters per word
HOST_LIMIT = 0.5  # shrunk failure rate of any rule above which a host is bad as a whole
RULE_LIMIT = 0.05  # shrunk failure rate of a rule above which a host's documents are not let off that rule

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("base", "symbols", "duplicate_lines", "word_length")


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows of `window` words that occur at least twice in the array.

    Windows are compared by a 64-bit hash within one document. Only documents in which two
    windows agree are sorted by it, to find where.
    """
    hashes = F.when(
        F.size(words) >= window,
        F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window))),
    ).otherwise(F.array().cast("array<bigint>"))

    def positions(hashed: Column) -> Column:
        placed = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def repeated(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            flagged = F.transform(s, lambda e, i: F.when(same(e, i - 1) | same(e, i + 1), e["p"]))
            return F.sort_array(F.filter(flagged, lambda p: p.isNotNull()))

        return let(placed, repeated)

    def covered(p: Column) -> Column:
        # Each window adds the words up to the start of the next one, at most its own length.
        parts = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(positions(h), covered)).otherwise(
            F.lit(0).cast("bigint")
        ),
    )


def measure(text: Column, window: int = WINDOW) -> Column:
    """A struct of `MEASURES` for a text; all zero for null."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeated_words(w, window).alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        )

    symbols = F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("bigint")
    return let(
        F.struct(let(space_words(text), of_words).alias("w"), let(lines, of_lines).alias("l"), symbols.alias("s")),
        lambda m: F.struct(
            m["w"]["n_words"].alias("n_words"),
            m["w"]["word_chars"].alias("word_chars"),
            m["s"].alias("n_symbols"),
            m["l"]["n_lines"].alias("n_lines"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def failures(m: Column) -> dict[str, Column]:
    """The rules of a document as booleans, in integer arithmetic."""
    n = m["n_words"]
    return {
        "base": (n < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PCT * n),
        "symbols": 100 * m["n_symbols"] > MAX_SYMBOLS_PCT * n,
        "duplicate_lines": 100 * m["n_dup_lines"] > MAX_DUPLICATE_LINES_PCT * m["n_lines"],
        "word_length": (m["word_chars"] < MIN_MEAN_LENGTH * n) | (m["word_chars"] > MAX_MEAN_LENGTH * n),
    }


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host and rule the failure rate, shrunk towards a beta prior: columns host, docs, rate_<rule>.

    The prior has the mean of all documents, and a weight found by the method of moments from how
    far the hosts' own rates scatter beyond what their sizes explain. Hosts that scatter no more
    than chance get the mean almost entirely (weight 10^6), one that explains all gets the least
    weight, 1. The totals are one row; null hosts count as one host.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("docs"), *[F.sum(F.col(f"fail_{r}").cast("bigint")).alias(f"n_{r}") for r in RULES]
    )
    total = F.sum("docs")
    moments = [F.count(F.lit(1)).alias("t_hosts"), total.alias("t_docs"), F.sum(F.col("docs") * F.col("docs")).alias("t_sq")]
    for r in RULES:
        moments += [
            F.sum(f"n_{r}").alias(f"t_{r}"),
            F.sum(F.col(f"n_{r}") * F.col(f"n_{r}") / F.col("docs")).alias(f"q_{r}"),
        ]
    totals = hosts.agg(*moments)
    out = hosts.crossJoin(F.broadcast(totals))  # one row
    for r in RULES:
        mean = F.col(f"t_{r}") / F.col("t_docs")
        within = mean * (1 - mean)
        # Weighted sum of squares between hosts, and what it is expected to be without any host effect.
        between = F.col(f"q_{r}") - F.col("t_docs") * mean * mean
        spread = (between - (F.col("t_hosts") - 1) * within) / (F.col("t_docs") - F.col("t_sq") / F.col("t_docs"))
        weight = F.when(
            (F.col("t_hosts") > 1) & (spread > 0), F.least(F.greatest(within / spread - 1, F.lit(1.0)), F.lit(1e6))
        ).otherwise(F.lit(1e6))
        out = out.withColumn(f"rate_{r}", (F.col(f"n_{r}") + mean * weight) / (F.col("docs") + weight))
    return out.select("host", "docs", *[f"rate_{r}" for r in RULES])


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: `row` (a struct of the carried columns), the measures, `base_failed`,
    `host_rate` (the host's highest shrunk rate), `host_bad` and `kept`.

    `kept` is false where the base rule fails, where the document fails another rule that too many of its
    host's documents fail (`RULE_LIMIT`), and where it fails any rule in a host that is bad as a whole
    (`HOST_LIMIT`). A document that fails another rule in a host where this is rare is let off. Null texts have no words and fail the base rule; null hosts are one host. Rows
    are never merged: repeated rows are measured each for itself. An empty table gives no rows.
    Other columns of `docs` may have any name.
    """
    inner = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(host).alias("host"), measure(F.col(text)).alias("m")
    )
    inner = inner.select("row", "host", "m", *[f.alias(f"fail_{r}") for r, f in failures(F.col("m")).items()])
    # Measured once; the totals and the documents both read the written rows.
    measured = stage(inner, "quality")
    rates = host_rates(measured, "host")
    # Written, so that its size is known when the join is planned: few hosts are broadcast by Spark itself,
    # and the documents stay where they are; many are joined by shuffles, in which a hot host is split.
    verdicts = stage(rates.select(
        F.col("host").alias("v_host"), F.greatest(*[f"rate_{r}" for r in RULES]).alias("host_rate"),
        *[(F.col(f"rate_{r}") > RULE_LIMIT).alias(f"strict_{r}") for r in RULES],
    ), "hosts")
    joined = null_safe_join(measured, verdicts, {"host": "v_host"})
    bad = F.col("host_rate") > HOST_LIMIT
    rejected = F.col("fail_base")
    for r in RULES:
        rejected = rejected | (F.col(f"fail_{r}") & (bad | F.col(f"strict_{r}")))
    return joined.select(
        "row",
        *[F.col("m")[c].alias(c) for c in MEASURES],
        F.col("fail_base").alias("base_failed"),
        "host_rate",
        bad.alias("host_bad"),
        (~rejected).alias("kept"),
    )


def quality_stage(docs: DataFrame) -> DataFrame:
    """The documents that the rules and their host's verdict keep, with all their columns."""
    judged = apply_rules(docs, carry=tuple(docs.columns))
    return judged.filter("kept").select("row.*")
