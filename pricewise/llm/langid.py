"""Language identification by fusing evidence (operator 3).

For each document the log-probabilities of every language add up:

* **text**: byte trigrams of its letters under a model of each language, against a
  background that holds all trigrams equally likely (``und``). Trigrams of one text
  aren't independent, so the sum is damped to that of ``n / (1 + n / DAMP)`` of them.
* **declared language** and **address suffix**: how often each value goes with each
  language in the whole table, by grouped sums of the text's posterior.
* **host**: a prior, the sums of the posteriors of the other documents of the host,
  smoothed towards its domain's, and those towards the whole table's
  (``KAPPA`` documents' worth each). A document's own posterior is taken out.

The text model is fitted on about ``SAMPLE`` labelled rows of each language, drawn
by a hash of the id; all else uses every row. Every label makes a language, however few
rows it has: its frequencies are smoothed towards those of all languages together
(``PRIOR`` trigrams' worth), and those towards the background. A document is rejected (lang null) if
``und`` wins or no language reaches a probability of one half.

Defined cases: a null or letterless text has no text evidence, so that the rest
decides against ``und``, which has the share of the table that it has; missing
evidence counts for nothing; a missing host has the table's prior; repeated rows
count each; extra columns stay; an empty table, or one without labels, gives rows
that are all rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.common import fresh, materialize
from pricewise.llm.ragged import slices, text_bytes

CELLS = 1 << 16
SAMPLE = 2000
PRIOR = 2000.0  # trigrams' worth of all languages' text that each language starts from
DAMP = 64.0
KAPPA = 20.0
SLICE = 2_000_000  # bytes of text in hand at once
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the trigrams of all texts, and each text's range of them. Letters are
    in lower case (ASCII and Latin-1), runs of other characters one blank."""
    b = _FOLD[data]
    if len(b) > 1:
        high = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        b[high] += 32
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    new_off = np.r_[0, np.cumsum(keep)][off]
    b = b[keep].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cell = (((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)
    inside = np.ones(len(cell), bool)  # not across two texts
    for back in (1, 2):
        ends = new_off[1:-1] - back
        inside[ends[(ends >= 0) & (ends < len(cell))]] = False
    at = np.r_[0, np.cumsum(inside)][np.minimum(new_off, len(cell))]
    return cell[inside].astype(np.int64), at


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
        ) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of the cells (CELLS x languages)."""
    have = labelled.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count()
    share = {row[0]: SAMPLE / row[1] for row in have.collect()}  # one row per language
    names = sorted(share)
    if not names:
        return [], np.zeros((CELLS, 0))
    place = F.create_map(*[x for k, s in share.items() for x in (F.lit(k), F.lit(s))])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(draw < place[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches):
        total = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                data, off = text_bytes(batch.column("text").filter(pa.array(langs == lang)))
                for i, j in slices(off):
                    n = np.bincount(trigrams(data[off[i]:off[j]], off[i:j + 1] - off[i])[0], minlength=CELLS)
                    total[lang] = total.get(lang, 0) + n
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "cell", "n"])

    tally = sample.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    seen = np.zeros((CELLS, len(names)))
    for lang, cell, n in tally.toPandas().itertuples(index=False):  # CELLS rows per language at most
        seen[cell, names.index(lang)] = n
    both = seen.sum(axis=1, keepdims=True)
    pooled = (both + 0.5) / (both.sum() + 0.5 * CELLS)
    return names, np.log((seen + PRIOR * pooled) / (seen.sum(axis=0) + PRIOR))


def score(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str, name: str) -> DataFrame:
    """The frame with one more column: the text's damped log-likelihoods, the
    background's last. Only the text goes to Python."""
    names, table = model
    held = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def likelihoods(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, off = text_bytes(texts)
            out = np.zeros((len(texts), len(names) + 1))
            for i, j in slices(off, SLICE):
                cell, at = trigrams(data[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.diff(at)
                weight = 1 / (1 + n / DAMP)
                for k in range(len(names)):
                    total = np.r_[0, np.cumsum(held.value[cell, k], dtype=np.float64)]
                    out[i:j, k] = np.diff(total[at]) * weight
                out[i:j, -1] = -np.log(CELLS) * n * weight
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    return docs.withColumn(name, likelihoods(F.col(text_col)))


def _softmax(logs: Column) -> Column:
    """Probabilities of an array of log-weights."""
    return F.transform(F.array(F.array_max(logs)), lambda top: F.transform(
        F.array(F.transform(logs, lambda x: F.exp(x - top))), lambda e: F.transform(
            e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0])[0]


def _sums(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """Sums of the posterior ``p`` by the keys, as an array."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[i]) for i in range(k)]).alias(name))


def fuse(scored: DataFrame, k: int, ll: str, declared: str, suffix: str, host: str, domain: str) -> DataFrame:
    """The frame with ``posterior`` (array, background last) from the text's
    log-likelihoods and the other evidence. The sums are one row per value."""
    names = fresh(scored, "p", "posterior", "all", "d_sum", "s_sum", "dom_sum", "host_sum", "k1", "k2", "k3", "k4")
    p, post, *_ = names
    rows = scored.select(F.col(declared).alias("declared"), F.col(suffix).alias("suffix"), F.col(host).alias("host"),
                         F.col(domain).alias("domain"), _softmax(F.col(ll)).alias("p"))
    every = rows.agg(*[F.coalesce(F.sum(F.col("p")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(k)]).first()
    total = [float(x) for x in every]  # one number per language
    whole = F.array(*[F.lit((x + 1) / (sum(total) + k)) for x in total])
    out = scored.withColumn(p, _softmax(F.col(ll)))

    for level, key, keys in ((names[3], names[7], ["declared"]), (names[4], names[8], ["suffix"]),
                             (names[5], names[9], ["domain"]), (names[6], names[10], ["host"])):
        column = {"declared": declared, "suffix": suffix, "domain": domain, "host": host}[keys[0]]
        table = _sums(rows.where(F.col(keys[0]).isNotNull()), keys, k, level).withColumnRenamed(keys[0], key)
        out = out.join(table, F.col(column) == F.col(key), "left")
    own = F.col(p)

    def likelihood(level: str) -> Column:
        """log P(value | language), up to what is the same for all languages."""
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(F.col(level).isNull(), F.lit(0.0)).otherwise(
            F.log((F.greatest(F.get(F.col(level), i) - F.get(own, i), F.lit(0.0)) + 0.5)
                  / (F.get(F.array(*map(F.lit, total)), i) + 1.0))))

    def smoothed(level: str, towards: Column) -> Column:
        rest = F.zip_with(F.col(level), own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
        return F.when(F.col(level).isNull(), towards).otherwise(F.transform(
            F.array(F.struct(rest.alias("r"), towards.alias("t"))), lambda a: F.zip_with(
                a["r"], a["t"], lambda x, t: (x + KAPPA * t) / (F.aggregate(a["r"], F.lit(0.0), lambda u, v: u + v) + KAPPA)))[0])

    prior = smoothed(names[6], smoothed(names[5], whole))
    logs = F.transform(F.arrays_zip(F.col(ll).alias("a"), likelihood(names[3]).alias("b"), likelihood(names[4]).alias("c"),
                                    prior.alias("d")), lambda x: x["a"] + x["b"] + x["c"] + F.log(x["d"]))
    return out.withColumn(post, _softmax(logs)).select(*scored.columns, F.col(post).alias(post))


def decide(fused: DataFrame, languages: list[str], posterior: str) -> tuple[Column, Column]:
    """(lang or null, probability of the likeliest)."""
    top = F.array_max(posterior)
    at = F.array_position(posterior, top).cast("int")
    name = F.get(F.array(*map(F.lit, [*languages, None])), at - 1)
    return F.when(top >= 0.5, name), top


def identify_pages(pages: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Per page: the id, lang (null: rejected), probability, declared, host."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    none = lambda c: F.when(c != "", c)
    host = none(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    rows = pages.select(
        F.col(id_col).alias("id"), text.alias("text"), host.alias("host"),
        none(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))).alias("declared")) \
        .withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))
    scored = materialize(score(rows, model, "text", "ll").drop("text"), "langid")
    fused = fuse(scored, len(model[0]) + 1, "ll", "declared", "suffix", "host", "domain")
    lang, probability = decide(fused, model[0], "posterior")
    return fused.select(F.col("id").alias(id_col), lang.alias("lang"), probability.alias("probability"), "declared", "host")


def keep_known(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents whose language is found, with all columns. ``lang`` counts as
    declared (and labels the sample), ``source`` as host.

    Each text is scored once, into a stage with its row number; sums and decisions read
    the numbers and scores alone. The texts meet nothing but the numbers of rejected
    rows."""
    model = fit(docs, "doc_id", text_col, lang_col)
    ll, at = fresh(docs, "ll", "at")
    stage = materialize(score(docs, model, text_col, ll).withColumn(at, F.monotonically_increasing_id()), "scored-docs")
    narrow = stage.select(F.col(at).alias("at"), F.col(ll).alias("ll"), F.col(lang_col).alias("declared"), F.col(source_col).alias("host"),
                          F.lit(None).cast("string").alias("nothing"))
    fused = fuse(narrow, len(model[0]) + 1, "ll", "declared", "nothing", "host", "nothing")
    rejected = fused.where(decide(fused, model[0], "posterior")[0].isNull()).select(F.col("at").alias(at))
    return stage.join(materialize(rejected, "rejected"), at, "left_anti").select(docs.columns)
