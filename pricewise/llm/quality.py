"""Quality by weak supervision (operator 8), in DataFrame functions only.

Seven rules vote good (1), bad (-1) or abstain (0) on each document. Their
accuracies are not given: expectation-maximisation finds, for each rule, how
often it votes good on good documents and bad on bad ones, and the share of good
documents. It sees the documents only as counts of vote patterns, at most 3**7
rows at any size of input, so one pass over the texts feeds it. A document is
kept if it passes the base rule and its posterior probability of being good is
at least one half.

Defined cases: a null text counts as empty; without words a document fails the
base rule; n_repeat_words uses 64-bit hashes of 3-word windows; repeated rows and
ties are judged alike; extra columns stay untouched; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import materialize

ROUNDS = 40

#: A rule: the share it looks at; it votes good up to the first bound, bad from the
#: second; it abstains between them, and where there is nothing to divide by.
RULES = {
    "symbols": ("try_divide(q.n_symbols, q.n_words)", 0.02, 0.15),
    "marks": ("try_divide(q.n_marks, q.word_chars)", 0.12, 0.20),
    "capitals": ("try_divide(q.n_capitals, q.word_chars)", 0.20, 0.50),
    "word_length": ("abs(try_divide(q.word_chars, q.n_words) - 6)", 4.0, 10.0),
    "same_lines": ("try_divide(q.n_dup_lines, q.n_lines)", 0.10, 0.30),
    "same_words": ("try_divide(q.n_repeat_words, q.n_words)", 0.25, 0.50),
    "endless_lines": ("1 - try_divide(q.n_ended, q.n_lines)", 0.50, 0.90),
}

# Words covered by 3-word windows that occur twice or more: windows are sorted by
# hash, those equal to a neighbour give positions, and each position covers up to
# three words that the one before it doesn't. A transform over a one-element array
# names a value, so that it is computed once.
_REPEATS = """
CASE WHEN size(a.w) < 4 THEN 0L ELSE transform(array(transform(sequence(0, size(a.w) - 3),
    i -> xxhash64(a.w[i], a.w[i + 1], a.w[i + 2]))), h ->
  CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
    transform(array(sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))), s ->
      transform(array(sort_array(transform(filter(s, (e, k) -> (k > 0 AND s[k - 1].x = e.x)
          OR (k < size(s) - 1 AND s[k + 1].x = e.x)), e -> e.i))), p ->
        aggregate(transform(p, (at, k) -> IF(k = 0, 3, least(3, at - p[k - 1]))), 0L, (x, y) -> x + y))[0])[0]
  END)[0] END"""

_COUNTS = r"""
transform(array(coalesce({text}, '')), t -> transform(array(named_struct(
    'w', filter(split(t, r'[\x20\x09-\x0D]+'), x -> x <> ''),
    'l', filter(split(t, r'\n'), x -> x rlike r'[^\x20\x09-\x0D]'),
    's', regexp_replace(t, r'[\x20\x09-\x0D]+', ''))), a -> named_struct(
  'n_words', CAST(size(a.w) AS LONG),
  'word_chars', CAST(length(a.s) AS LONG),
  'n_symbols', CAST(length(a.s) - length(translate(a.s, '#*$%&|<>', '')) AS LONG),
  'n_lines', CAST(size(a.l) AS LONG),
  'n_dup_lines', CAST(size(a.l) - size(array_distinct(a.l)) AS LONG),
  'n_repeat_words', {repeats},
  'n_marks', CAST(length(regexp_replace(a.s, r'\p{{L}}+', '')) AS LONG),
  'n_capitals', CAST(length(a.s) - length(regexp_replace(a.s, r'\p{{Lu}}+', '')) AS LONG),
  'n_ended', CAST(size(filter(a.l, x -> x rlike r'[.!?:;"»”)…。][\x20\x09-\x0D]*$')) AS LONG)))[0])[0]"""

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FAILED = "(q.n_words < 50 OR 100 * q.n_repeat_words > 50 * q.n_words)"


def counts(text_col: str) -> str:
    """SQL for a struct of the counts that the rules use."""
    return _COUNTS.format(text=f"`{text_col}`", repeats=_REPEATS)


def votes(q: str) -> str:
    """SQL for the array of votes; documents that fail the base rule aren't voted on."""
    cases = (f"CASE WHEN {share} <= {good} THEN 1 WHEN {share} >= {bad} THEN -1 ELSE 0 END"
             for share, good, bad in RULES.values())
    return f"array({', '.join(cases)})".replace("q.", f"{q}.")


def _log_odds(prior: str, good: str, bad: str, v: str) -> str:
    """Log-odds of a good document, given the votes ``v``."""
    return (f"aggregate(transform({v}, (z, r) -> CASE z WHEN 1 THEN ln({good}[r] / (1 - {bad}[r])) "
            f"WHEN -1 THEN ln((1 - {good}[r]) / {bad}[r]) ELSE 0D END), ln({prior} / (1 - {prior})), (x, y) -> x + y)")


def _rate(kind: str, vote: int, weight: str) -> str:
    """Share of the vote among the votes of each rule, weighted; starts from a few
    documents' worth of belief that rules are better than a coin."""
    hit = f"aggregate(e, 8D, (x, y) -> x + IF(y.v[r] = {vote}, y.n * {weight}, 0D))"
    cast = f"aggregate(e, 10D, (x, y) -> x + IF(y.v[r] <> 0, y.n * {weight}, 0D))"
    low = 0.6 if kind == "good" else 0.05
    return f"transform(sequence(0, {len(RULES) - 1}), r -> greatest({low}D, least(0.999D, {hit} / {cast})))"


def fit(voted: DataFrame) -> tuple[float, list[float], list[float]]:
    """Share of good documents, and each rule's accuracy on good and on bad ones, from
    a frame with a column ``v`` of votes (null: not judged)."""
    tally = voted.groupBy("v").agg(F.count("*").cast("double").alias("n"))
    k = len(RULES)
    start = f"named_struct('prior', 0.8D, 'good', array_repeat(0.9D, {k}), 'bad', array_repeat(0.5D, {k}))"
    step = f"""(p, turn) -> transform(array(transform(tally, x -> named_struct('v', x.v, 'n', x.n, 'q',
        1 / (1 + exp(-{_log_odds("p.prior", "p.good", "p.bad", "x.v")}))))), e -> named_struct(
          'prior', greatest(0.05D, least(0.95D, aggregate(e, 0D, (x, y) -> x + y.n * y.q) / aggregate(e, 0D, (x, y) -> x + y.n))),
          'good', {_rate("good", 1, "y.q")}, 'bad', {_rate("bad", -1, "(1 - y.q)")}))[0]"""
    one = tally.agg(F.sort_array(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("v", "n")))).alias("tally")) \
        .selectExpr(f"IF(size(tally) = 0, {start}, aggregate(sequence(1, {ROUNDS}), {start}, {step})) AS m").first()["m"]
    return one["prior"], one["good"], one["bad"]


def verdict(model: tuple[float, list[float], list[float]], v: str) -> str:
    """SQL for the posterior probability of a good document."""
    prior, good, bad = model
    row = lambda xs: f"array({', '.join(f'{x!r}D' for x in xs)})"
    return f"1 / (1 + exp(-{_log_odds(f'{prior!r}D', row(good), row(bad), v)}))"


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the base counts, ``base_failed``, ``posterior`` and ``kept``."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.expr(counts(text_col)).alias("q"))
                       .withColumn("v", F.expr(votes("q"))), "quality")
    model = fit(rows.where(f"NOT {FAILED}").select("v"))
    failed = F.expr(FAILED)
    posterior = F.expr(verdict(model, "v"))
    return rows.select(F.col("id").alias(id_col), *(F.col(f"q.{c}") for c in BASE), failed.alias("base_failed"),
                       posterior.alias("posterior"), (~failed & (posterior >= 0.5)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all columns."""
    # each pass states its condition as one expression over one value q: columns that a
    # filter uses would be put into it, and so computed, once for each mention
    every = f"transform(array({counts(text_col)}), q -> "
    model = fit(docs.select(F.expr(f"{every}IF({FAILED}, CAST(NULL AS ARRAY<INT>), {votes('q')}))[0]").alias("v")))
    return docs.where(F.expr(f"{every}NOT {FAILED} AND {verdict(model, votes('q'))} >= 0.5D)[0]"))
