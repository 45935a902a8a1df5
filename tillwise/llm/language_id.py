"""Language of web pages from four kinds of evidence, put together by Bayes' rule.

* The visible text, by character trigrams: their counts per language come from all labelled documents.
* The language declared in the markup, and the address suffix: how often each goes with each language is
  counted over the pages themselves.
* The host: a prior per host, smoothed towards its domain, that towards its suffix, that towards all.

Trigrams are hashed into a fixed number of cells, so the text model has a size set by parameters. Counts
are summed inside the tasks before they are shuffled.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scale import stage

CELLS = 1 << 14
MAX_LANGUAGES = 64  # the text model has at most this many times CELLS numbers: 8 MB
TEXT_WEIGHT = 0.1  # trigrams overlap and depend on each other; full weight would drown all else
SMOOTHING = 8.0  # pseudo-pages that each level of the host hierarchy takes from the one above
HIDDEN = re.compile(r"<(?:!--|(script|style|noscript)\b)", re.IGNORECASE)
HIDDEN_ENDS = {
    None: re.compile("-->"), "script": re.compile(r"</script\s*>", re.IGNORECASE), "style": re.compile(r"</style\s*>", re.IGNORECASE),
    "noscript": re.compile(r"</noscript\s*>", re.IGNORECASE),
}
LANG_ATTRIBUTE = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})"
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def visible_text(page: str) -> str:
    """The page without tags, comments and scripts; one pass, also over pages that never close them."""
    parts, at, unclosed = [], 0, set()
    while (start := page.find("<", at)) >= 0:
        parts.append(page[at:start])
        hidden = HIDDEN.match(page, start)
        kind = (hidden[1] or "").lower() or None if hidden else ""
        end = -1
        if hidden and kind not in unclosed:
            found = HIDDEN_ENDS[kind].search(page, hidden.end())
            end = found.end() if found else -1
            if not found:
                unclosed.add(kind)
        if end < 0:
            end = page.find(">", start) + 1
        if not end:
            at = start + 1
            break
        at = end
    return html_lib.unescape(" ".join([*parts, page[at:]]))


def cells(text: str, n: int = CELLS) -> np.ndarray:
    """Hash cells of the character trigrams of a text, lower-cased, without digits and symbols."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    code = np.frombuffer(f" {' '.join(letters.split())} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(code) < 3:
        return np.empty(0, np.int64)
    mixed = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1] * np.uint64(0x85EBCA77) + code[2:] * np.uint64(0xC2B2AE3D))
    mixed = (mixed ^ (mixed >> np.uint64(17))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((mixed >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = totals.setdefault(lang, np.zeros(n, np.int64))
                own += np.bincount(cells(text, n), minlength=n)
                if len(totals) > 4 * MAX_LANGUAGES:
                    yield from _emit(totals)
                    totals = {}
        yield from _emit(totals)

    def _emit(totals: dict) -> Iterator[pa.RecordBatch]:
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())],
                names=["lang", "cell", "n"],
            )

    return run


def train_text_model(docs: DataFrame, text: str = "text", lang: str = "lang", n_cells: int = CELLS) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (language, cell) from all labelled documents.

    Documents without label or text teach nothing. The languages are those of most trigrams, at most
    MAX_LANGUAGES; only their sums, at most MAX_LANGUAGES x n_cells numbers, come to the driver.
    """
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    counts = labelled.mapInArrow(_count(n_cells), "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    counts = stage(counts, "trigrams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    languages = sorted(r["lang"] for r in sizes)
    model = np.full((len(languages), n_cells), 0.5)
    index = {x: i for i, x in enumerate(languages)}
    if languages:
        known = counts.filter(F.col("lang").isin(languages)).toArrow()
        at = np.array([index[x] for x in known["lang"].to_pylist()], np.int64)
        model[at, known["cell"].to_numpy()] += known["n"].to_numpy()  # one row per language and cell
    return languages, np.log(model / model.sum(axis=1, keepdims=True)) if languages else model


def _text_scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs: np.ndarray = model.value
        for batch in batches:
            scores = []
            for page in batch.column("html").to_pylist():
                counts = np.bincount(cells(visible_text(page or "")), minlength=logs.shape[1])
                at = np.flatnonzero(counts)
                own = logs[:, at] @ counts[at]
                scores.append((own - own.max() if len(own) else own).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.list_(pa.float64()))], names=["row", "text_scores"])

    return run


def _suffix(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+)$", 1)


def _domain(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)


def _posterior(prior: Column, likelihoods: list[Column]) -> Column:
    """Normalised probabilities from arrays of log values."""
    total = prior
    for other in likelihoods:
        total = F.zip_with(total, other, lambda a, b: a + b)
    top = F.array_max(total)
    weights = F.transform(total, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, x: a + x))


def identify(
    pages: DataFrame, languages: list[str], model: np.ndarray, page: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang, declared, host, host_lang.

    `text_lang` is the best by text alone, `host_lang` by the host's prior alone. Language names are the
    model's; a declared language among them counts as evidence, any other as "other", none as "none".
    Null pages have no text, null addresses no host; they are judged by what is left. Ties go to the first
    name. Without languages all results are null. Rows are judged each for itself.
    """
    spark = pages.sparkSession
    inner = pages.select(
        F.struct(F.col(page).alias("page_id"), F.col(url).cast("string").alias("url"),
                 F.lower(F.regexp_extract(F.col(html), LANG_ATTRIBUTE, 1)).alias("attribute")).alias("row"),
        F.col(html).cast("string").alias("html"),
    )
    schema = T.StructType([inner.schema["row"], T.StructField("text_scores", T.ArrayType(T.DoubleType()))])
    scored = inner.mapInArrow(_text_scores(spark.sparkContext.broadcast(model)), schema)
    names = F.array(*[F.lit(x) for x in languages]) if languages else F.array().cast("array<string>")
    host = F.lower(F.regexp_extract(F.coalesce("row.url", F.lit("")), HOST, 1))
    attribute = F.coalesce("row.attribute", F.lit(""))
    # Scored once; the counts and the pages both read the written rows.
    rows = stage(scored.select(
        F.col("row.page_id").alias("page_id"), host.alias("host"), _domain(host).alias("domain"), _suffix(host).alias("suffix"),
        F.when(attribute == "", "none").when(F.array_contains(names, attribute), attribute).otherwise("other").alias("declared"),
        F.transform("text_scores", lambda x: x * TEXT_WEIGHT).alias("text_scores"),
    ), "page-evidence")
    if not languages:
        return rows.select("page_id", *[F.lit(None).cast(t).alias(n) for n, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"))],
                           "declared", "host", F.lit(None).cast("string").alias("host_lang"))
    k = len(languages)
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    zero = F.array(*[F.lit(0.0)] * k)
    own = rows.withColumn("p", _posterior(zero, [F.col("text_scores")]))
    # Soft counts: a page counts for each language by its text's probability.
    soft = [F.sum(F.col("p")[i]).alias(f"c{i}") for i in range(k)]
    counts = F.array(*[F.col(f"c{i}") for i in range(k)])

    def smoothed(parent: Column) -> Column:
        """Log prior of a level: its counts and SMOOTHING pages of its parent's distribution."""
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, parent, lambda c, q: (c + SMOOTHING * q) / (total + SMOOTHING))

    by_host = own.groupBy("host", "domain", "suffix").agg(*soft)
    overall = by_host.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).select(
        smoothed(F.array(*[F.lit(1.0 / k)] * k)).alias("all_prior")
    )
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]
    suffixes = by_host.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(overall)).select(  # one row
        "suffix", "all_prior", smoothed(F.col("all_prior")).alias("suffix_prior"))
    domains = by_host.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix").select(
        "domain", "suffix", "all_prior", "suffix_prior", smoothed(F.col("suffix_prior")).alias("domain_prior"))
    hosts = by_host.join(domains, ["domain", "suffix"]).select(
        "host", F.transform(smoothed(F.col("domain_prior")), lambda x: F.log(x)).alias("host_prior"))
    marks = own.groupBy("declared").agg(*soft).crossJoin(F.broadcast(own.agg(*[F.sum(F.col("p")[i]).alias(f"t{i}") for i in range(k)])))
    declared = marks.select(
        F.col("declared").alias("mark"),
        F.array(*[F.log((F.col(f"c{i}") + 0.5) / (F.col(f"t{i}") + 0.5 * (k + 2))) for i in range(k)]).alias("mark_scores"),
    )
    joined = rows.join(hosts, "host").join(F.broadcast(declared), F.col("declared") == F.col("mark"))  # at most k + 2 rows
    fused = joined.select("*", _posterior(F.col("host_prior"), [F.col("mark_scores"), F.col("text_scores")]).alias("fused"))
    return fused.select(
        "page_id", best(F.col("fused")).alias("lang"), F.array_max("fused").alias("probability"),
        best(F.col("text_scores")).alias("text_lang"), "declared", "host", best(F.col("host_prior")).alias("host_lang"),
    )
