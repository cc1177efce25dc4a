"""Quality rules per document and per host, in DataFrame functions only.

Each text is measured and judged by four rules: ``base`` (too few words, or mostly repeated ones),
``symbols`` (more than a tenth as many symbols as words), ``lines`` (over half the lines are copies
of earlier ones) and ``word_length`` (a mean below 2 or above 12 characters). A document that
breaks a rule goes. The failures of each rule, and of ``any``, are counted by host; a host's rate is
shrunk towards the rate of all documents by a beta prior fitted to the hosts: its spread is what
the hosts differ by beyond what their sizes explain. A host is rejected, with all its documents,
where one of its shrunk rates is above that rule's limit: ``host_deviations`` standard deviations of the
prior above its mean, but within ``host_limits``. So hosts that are all alike are left alone however
large they are, and a host that stands out is rejected the sooner the less hosts differ.

Hosts are counted with map-side sums, so a host with a third of all rows costs one row per task;
the verdict joins back on the host, a table of one row per host. Rows without a host are judged
by the rules alone and take no part in the prior.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import fresh, read_table
from mercata.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10  # of the words
MAX_DUP_LINE_PCT = 50
WORD_LENGTH = (2, 12)  # mean characters of a word
HOST_DEVIATIONS = 2.0
HOST_LIMITS = (0.3, 0.5)
MOST_WEIGHT = 1e6  # of a prior, in documents
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("base", "symbols", "lines", "word_length")


def measured(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct column ``out`` of the measures, ``base_failed`` and ``failed``, the names of the rules broken.

    A null text has no words and breaks ``base`` alone. Repeated three-word windows are found by sorting the
    windows' hashes inside the row, so a long text costs n log n and never leaves its row.
    """
    names: list[str] = []

    def step(frame: DataFrame, label: str, column) -> DataFrame:
        names.append(fresh(frame, f"{out}_{label}"))
        return frame.withColumn(names[-1], column)

    body = F.coalesce(F.col(text), F.lit(""))
    df = step(df, "words", F.filter(F.split(body, f"{SPACE}+"), lambda w: w != ""))
    words = names[-1]
    df = step(
        df,
        "windows",
        F.expr(
            f"CASE WHEN size(`{words}`) < 3 THEN array() ELSE transform(sequence(2, size(`{words}`) - 1), "
            f"i -> xxhash64(`{words}`[i - 2], `{words}`[i - 1], `{words}`[i])) END"
        ),
    )
    windows = names[-1]
    # Only a text that repeats a window has its windows sorted.
    df = step(
        df,
        "sorted",
        F.expr(
            f"CASE WHEN size(array_distinct(`{windows}`)) < size(`{windows}`) "
            f"THEN sort_array(transform(`{windows}`, (h, i) -> struct(h, i))) END"
        ),
    )
    ordered = names[-1]
    df = step(
        df,
        "places",
        F.expr(
            f"CASE WHEN `{ordered}` IS NOT NULL THEN sort_array(transform(filter("
            f"sequence(0, size(`{ordered}`) - 1), k -> "
            f"(k > 0 AND `{ordered}`[greatest(k - 1, 0)].h = `{ordered}`[k].h) OR "
            f"(k < size(`{ordered}`) - 1 AND `{ordered}`[least(k + 1, size(`{ordered}`) - 1)].h = `{ordered}`[k].h)), "
            f"k -> `{ordered}`[k].i)) END"
        ),
    )
    places = names[-1]
    # Each repeated window covers three words, less those the next repeated window covers.
    repeat = F.expr(
        f"CASE WHEN `{places}` IS NULL THEN 0L ELSE 3L + aggregate(sequence(1, size(`{places}`) - 1), 0L, "
        f"(sum, k) -> sum + least(3, `{places}`[k] - `{places}`[k - 1])) END"
    )
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = step(df, "lines", lines)
    row_lines = names[-1]
    measures = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.concat_ws("", F.col(words))).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(row_lines) - F.size(F.array_distinct(F.col(row_lines)))).cast("long"),
        "n_repeat_words": repeat,
        "n_lines": F.size(row_lines).cast("long"),
    }
    df = df.withColumn(out, F.struct(*[c.alias(k) for k, c in measures.items()])).drop(*names)
    m = {k: F.col(out)[k] for k in measures}
    broken = {
        "base": (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"]),
        "symbols": 100 * m["n_symbols"] > MAX_SYMBOL_PCT * m["n_words"],
        "lines": 100 * m["n_dup_lines"] > MAX_DUP_LINE_PCT * m["n_lines"],
        "word_length": (m["word_chars"] < WORD_LENGTH[0] * m["n_words"]) | (m["word_chars"] > WORD_LENGTH[1] * m["n_words"]),
    }
    failed = F.array_compact(F.array(*[F.when(broken[r], F.lit(r)) for r in RULES]))
    return df.withColumn(out, F.col(out).withField("base_failed", broken["base"]).withField("failed", failed))


def host_verdicts(
    rows: DataFrame,
    host: str,
    failed,
    deviations: float = HOST_DEVIATIONS,
    limits: tuple[float, float] = HOST_LIMITS,
) -> DataFrame:
    """Per host: the shrunk rate of documents that break any rule, and whether the host is rejected.

    ``failed`` is the array of the names of the rules a row breaks. One row of sums goes to the driver.
    """
    kinds = {"any": F.size(failed) > 0} | {r: F.array_contains(failed, r) for r in RULES}
    hosts = (
        rows.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("docs"), *[F.count_if(c).alias(k) for k, c in kinds.items()])
    )
    hosts = cut_lineage(hosts, "host-failures")
    docs = F.col("docs").cast("double")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("docs").alias("docs"),
        F.sum(docs * docs).alias("squares"),
        *[F.sum(k).alias(k) for k in kinds],
        *[F.sum(F.col(k) * F.col(k) / docs).alias(f"{k}_squares") for k in kinds],
    ).first()
    rates, above = {}, []
    for kind in kinds:
        mean, weight = beta_prior(sums["hosts"], sums["docs"], sums["squares"], sums[kind], sums[f"{kind}_squares"])
        limit = mean + deviations * (mean * (1 - mean) / (weight + 1)) ** 0.5
        rates[kind] = (F.col(kind) + F.lit(mean * weight)) / (docs + F.lit(weight))
        above.append(rates[kind] > F.lit(min(max(limit, limits[0]), limits[1])))
    return hosts.select("host", rates["any"].alias("rate"), reduce(or_, above).alias("rejected"))


def beta_prior(
    hosts: int, docs: int | None, squares: float | None, failures: int | None, failure_squares: float | None
) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta distribution that the hosts' rates come from, by moments.

    ``squares`` is the sum of docs * docs over hosts, ``failure_squares`` that of failures * failures / docs. The
    hosts' rates, weighted by their documents, spread by chance by ``hosts - 1`` units of mean * (1 - mean);
    only what is beyond that counts. Hosts that differ no more than by chance have the largest weight.
    """
    if not docs:
        return 0.0, 1.0
    mean = failures / docs
    unit, room = mean * (1 - mean), docs - hosts + 1 - squares / docs
    if unit <= 0 or room <= 0:
        return mean, MOST_WEIGHT
    shared = ((failure_squares - docs * mean * mean) / unit - (hosts - 1)) / room
    return mean, min(max(1 / shared - 1, 0.0), MOST_WEIGHT) if shared > 0 else MOST_WEIGHT


def judged(
    df: DataFrame,
    *,
    text: str = "text",
    host: str = "source",
    host_deviations: float = HOST_DEVIATIONS,
    host_limits: tuple[float, float] = HOST_LIMITS,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all, unless given) with a last struct column of measures and verdicts.

    The struct has the measures, ``base_failed``, ``failed`` (names of the rules broken), ``host_rate`` (of documents
    that break any rule, shrunk; null without a host), ``host_rejected`` and ``kept``.
    Its name is ``quality``, lengthened by underscores if a column has that name. The measured
    rows are written once; repeated rows stay repeated, since no row is joined by its id.
    """
    columns = df.columns if keep is None else keep
    out = fresh(df, "quality")
    place = fresh(df, "quality_host")
    rows = measured(df, text, out).select(*[F.col(f"`{c}`") for c in columns], F.col(host).alias(place), out)
    rows = cut_lineage(rows, "quality")
    # Written, so that Spark knows its size and moves no text where it is small.
    verdicts = host_verdicts(rows, place, F.col(out)["failed"], host_deviations, host_limits)
    hosts = cut_lineage(
        verdicts.select(
            F.col("host").alias(place), F.col("rate").alias(f"{out}_rate"), F.col("rejected").alias(f"{out}_rejected")
        ),
        "hosts",
    )
    rejected = F.coalesce(F.col(f"{out}_rejected"), F.lit(False))
    judgement = F.col(out).withField("host_rate", F.col(f"{out}_rate")).withField("host_rejected", rejected)
    return rows.join(hosts, place, "left").select(
        *[F.col(f"`{c}`") for c in columns],
        judgement.withField("kept", (F.size(F.col(out)["failed"]) == 0) & ~rejected).alias(out),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS body FROM documents
), w AS (
  SELECT doc_id, source, body,
         regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), v AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM v) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.source, len(words)::BIGINT AS n_words,
         length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words AS symbols, 100 * n_dup_lines > 50 * n_lines AS lines,
         word_chars < 2 * n_words OR word_chars > 12 * n_words AS word_length
  FROM m
), k AS (
  SELECT source, kind, count(*) AS n, count(*) FILTER (WHERE broken)::DOUBLE AS f
  FROM (
    SELECT source, unnest(['any', 'base', 'symbols', 'lines', 'word_length']) AS kind,
           unnest([base_failed OR symbols OR lines OR word_length, base_failed, symbols, lines, word_length]) AS broken
    FROM b WHERE source IS NOT NULL
  ) GROUP BY source, kind
), p AS (
  SELECT kind, sum(f) / sum(n) AS mean, sum(f) / sum(n) * (1 - sum(f) / sum(n)) AS unit,
         (sum(f * f / n) - sum(f) * sum(f) / sum(n)) AS spread, count(*) - 1 AS chance,
         sum(n) - count(*) + 1 - sum(n * n) / sum(n) AS room
  FROM k GROUP BY kind
), q AS (
  SELECT kind, mean, unit,
         CASE WHEN unit > 0 AND room > 0 AND spread / unit > chance
              THEN least(greatest(room / (spread / unit - chance) - 1, 0), 1e6) ELSE 1e6 END AS weight
  FROM p
), s AS (
  SELECT source, bool_or((f + mean * weight) / (n + weight)
                         > least(greatest(mean + 2 * sqrt(unit / (weight + 1)), 0.3), 0.5)) AS rejected
  FROM k JOIN q ON k.kind = q.kind GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR symbols OR lines OR word_length OR coalesce(rejected, FALSE)) AS kept,
       concat_ws(',', CASE WHEN base_failed THEN 'base' END, CASE WHEN symbols THEN 'symbols' END,
                 CASE WHEN lines THEN 'lines' END, CASE WHEN word_length THEN 'word_length' END) AS rules_failed,
       coalesce(rejected, FALSE) AS host_rejected
FROM b LEFT JOIN s ON b.source = s.source
"""


def query(spark, sf_dir: str) -> DataFrame:
    rows = judged(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    quality = F.col(rows.columns[-1])
    names = F.concat_ws(",", quality["failed"]).alias("rules_failed")
    plain = [quality[m].alias(m) for m in (*MEASURES, "base_failed", "kept", "host_rejected")]
    return rows.select("doc_id", *plain, names)
