"""Quality rules whose thresholds follow the data.

Every document is measured; per language and source the measures are summed up in quantile
sketches, and a document is rejected where a measure lies far outside its group's usual range:
more than :data:`FENCE` spreads above an upper percentile of the group's own sketch. A spread is the
distance between two percentiles, and has a small minimum for groups whose documents are all alike.

The sketch is a histogram over buckets of bounded relative width: values under 32 are exact, above
that each power of two has 16 buckets. Counts add up, so sketches merge in any order with the same
result, a hot source is reduced before anything is shuffled, and a group too small to be judged by
itself uses the merged sketch of its language, then that of all documents. A sketch has at most
16 * 64 buckets whatever the number of documents.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fresh
from tidemark.session import staged

WORD_BREAK = r"[\x20\x09-\x0D]+"
MIN_WORDS = 10
#: Share of repeated words, in percent, beyond which a text fails whatever its group.
MAX_REPEAT_PERCENT = 20
#: Measures: what is measured, the smallest spread of a group, and the percentiles of its sketch
#: between which the spread is taken. Shares are in thousandths, word length in hundredths. Shares
#: are 0 in most documents, so their spread is that of the upper tail; word length lies around its
#: middle, where the quartiles tell more.
MEASURES = {
    "symbols": ("1000 * n_symbols div greatest(1, word_chars)", 30, 50, 90),
    "dup_lines": ("1000 * n_dup_lines div greatest(1, n_lines)", 40, 50, 95),
    "repeats": ("1000 * n_repeat_words div greatest(1, n_words)", 10, 50, 95),
    "word_length": ("100 * word_chars div greatest(1, n_words)", 16, 25, 75),
}
#: A limit of a measure with a maximum never stands above this, however wide its group: the shares
#: end at 1000, and repeats at 200 as the base rule takes the rest.
CEILINGS = {"symbols": 900, "dup_lines": 900, "repeats": 190}
#: The limit stands this many spreads above the upper percentile.
FENCE = 6
#: Groups with fewer documents use the sketch of their language, then that of all documents.
MIN_GROUP = 50
#: Thresholds are broadcast up to this many groups; beyond it, joined like any table.
MAX_BROADCAST_GROUPS = 20_000


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of :data:`MEASURES`; columns of these names are replaced.

    n_words, word_chars (code points in words), n_symbols, n_lines and n_dup_lines (lines with a
    word; those equal to an earlier one), n_repeat_words (words in 5-word windows found at least
    twice). Null and empty texts: all 0.

    A window is compared by a 64-bit hash. Windows are sorted with their places inside the row, so
    a text of n words takes n log n steps, and only where a first, cheap test finds a repeat.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    docs = fresh(docs, *own)
    kept = [f"`{c}`" for c in docs.columns]
    texts = docs.selectExpr(
        *kept, rf"filter(split(coalesce(text, ''), r'{WORD_BREAK}'), w -> w <> '') as _words",
        r"filter(split(coalesce(text, ''), '\n'), l -> l rlike r'[^\x20\x09-\x0D]') as _lines",
    )
    grams = texts.selectExpr(
        "*",
        "if(size(_words) < 6, cast(array() as array<bigint>), "
        "transform(sequence(0, size(_words) - 5), i -> xxhash64(get(_words, i), "
        "get(_words, i + 1), get(_words, i + 2), get(_words, i + 3), get(_words, i + 4)))) "
        "as _grams",
    )
    places = grams.selectExpr(
        "*",
        "if(size(array_distinct(_grams)) = size(_grams), null, "
        "array_sort(transform(_grams, (g, i) -> struct(g as g, i as i)))) as _sorted",
    ).selectExpr(
        "*",
        "if(_sorted is null, null, array_sort(transform(filter(transform(_sorted, (s, i) -> "
        "struct(s.i as i, s.g <=> get(_sorted, i - 1).g or s.g <=> get(_sorted, i + 1).g as twice)"
        "), s -> s.twice), s -> s.i))) as _places",
    )
    counts = {
        "n_words": "cast(size(_words) as bigint)",
        "word_chars": "cast(length(array_join(_words, '')) as bigint)",
        "n_symbols": "cast(regexp_count(coalesce(text, ''), r'[#*$%&|<>]') as bigint)",
        "n_lines": "cast(size(_lines) as bigint)",
        "n_dup_lines": "cast(size(_lines) - size(array_distinct(_lines)) as bigint)",
        "n_repeat_words":
            "if(_places is null, 0L, aggregate(transform(_places, (p, i) -> "
            "least(5, coalesce(get(_places, i + 1) - p, 5))), 0L, (a, x) -> a + x))",
    }
    # As rows of a generator: a filter on the counts then stays above them, where it would
    # otherwise be pushed down with all these expressions written out in it.
    fields = ", ".join(f"'{name}', {text}" for name, text in counts.items())
    return places.selectExpr(*kept, f"inline(array(named_struct({fields})))")


BASE_FAILED = (f"(n_words < {MIN_WORDS} or "
               f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)")


def _shift(v: str) -> str:
    return f"greatest(0, length(bin({v})) - 5)"


def bucket(v: str) -> str:
    """SQL text: sketch bucket of a count from 0; its inverse is :func:`bucket_floor`."""
    return f"cast({_shift(v)} * 16 + shiftright({v}, {_shift(v)}) as bigint)"


def bucket_floor(b: str) -> str:
    """SQL text: the smallest value of a bucket."""
    shift = f"greatest(0, ({b}) div 16 - 1)"
    return f"shiftleft(cast(({b}) - {shift} * 16 as bigint), cast({shift} as int))"


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): one mergeable sketch per group and measure.

    Over documents that pass the fixed base rules. Each document is counted in the partial
    aggregate of its own task, so what is shuffled grows with groups and buckets, not documents.
    """
    parts = ", ".join(f"'{name}', {expr}" for name, (expr, *_) in MEASURES.items())
    return (
        measures.filter(f"not {BASE_FAILED}")
        .selectExpr("lang", "source", f"stack({len(MEASURES)}, {parts}) as (measure, value)")
        .selectExpr("lang", "source", "measure", f"{bucket('value')} as bucket")
        .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))
    )


def merged(parts: DataFrame, *group: str) -> DataFrame:
    """Sketches added up over all groups that agree in ``group``."""
    return parts.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))


def limit(measure: str, low: str, high: str) -> str:
    """SQL text: the limit of a measure from the two percentiles of a sketch."""
    _, least, _, _ = MEASURES[measure]
    fence = f"{high} + {FENCE} * greatest({high} - {low}, {least})"
    return f"least({CEILINGS[measure]}, {fence})" if measure in CEILINGS else fence


def fences(parts: DataFrame, *group: str) -> DataFrame:
    """(group..., docs, one limit per measure) from the sketches of each group."""
    by = ", ".join([*group, "measure"])
    ranked = parts.selectExpr(
        *group, "measure", "bucket", f"sum(n) over (partition by {by} order by bucket) as upto",
        f"sum(n) over (partition by {by}) as docs",
    )

    def at(measure: str, percent: int) -> str:
        return (f"min(if(measure = '{measure}' and 100 * upto >= docs * {percent}, "
                f"{bucket_floor('bucket')}, null))")

    return ranked.groupBy(*group).agg(
        F.max("docs").alias("docs"),
        *[F.expr(limit(m, at(m, low), at(m, high))).alias(m)
          for m, (_, _, low, high) in MEASURES.items()],
    )


def thresholds(measures: DataFrame) -> DataFrame:
    """(lang, source, one limit per measure): the row a document of that group is held against.

    Every group of ``measures`` has a row, also groups whose documents all fail the base rules.
    """
    parts = staged(sketches(measures))
    groups = measures.select("lang", "source").distinct()
    overall = fences(merged(parts)).first()
    found = groups.alias("g")
    for depth, group in enumerate((("lang", "source"), ("lang",))):
        table = fences(merged(parts, *group), *group)
        wide = table.toDF(*[f"_{c}{depth}" for c in group],
                          *[f"{c}{depth}" for c in table.columns[len(group):]])
        on = " and ".join(f"g.{c} <=> _{c}{depth}" for c in group)
        found = found.join(wide, F.expr(on), "left")
    # Without a document that passes the base rules there is nothing to hold against a limit.
    limits = [
        f"coalesce(if(docs0 >= {MIN_GROUP}, {m}0, null), if(docs1 >= {MIN_GROUP}, {m}1, null), "
        f"{limit(m, '0', '0') if overall[m] is None else overall[m]}) as max_{m}"
        for m in MEASURES
    ]
    return found.selectExpr("g.lang", "g.source", *limits)


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with base_failed, kept and ``failed`` (the first rule that rejected it)."""
    reasons = " ".join(
        f"when ({expr}) > max_{m} then '{m}'" for m, (expr, *_) in MEASURES.items()
    )
    names = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    small = limits.count() <= MAX_BROADCAST_GROUPS
    joined = measures.alias("m").join(
        F.broadcast(names) if small else names,
        F.expr("m.lang <=> _lang and m.source <=> _source"), "left",
    )
    return joined.selectExpr(
        *[f"m.`{c}`" for c in measures.columns], f"{BASE_FAILED} as base_failed",
        f"case when n_words < {MIN_WORDS} then 'words' when {BASE_FAILED} then 'repeats' "
        f"{reasons} end as failed",
    ).selectExpr("*", "failed is null as kept")


def counted(docs: DataFrame) -> DataFrame:
    """The counts of every row without its text, staged: the one reading of the texts on which
    sketches, groups and verdicts rest."""
    return staged(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"))


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document row: its counts, base_failed, kept and the rule that failed.

    Null text counts as empty and fails; null language or source form groups of their own. Repeated
    rows count as often as they occur and get equal verdicts; an empty table gives no rows.
    """
    counts = counted(docs)
    return judged(counts, staged(thresholds(counts)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged. Texts are read twice but not shuffled.

    Repeated rows stay or go together; an empty table stays empty.
    """
    limits = staged(thresholds(counted(docs)))
    rows = docs.selectExpr("struct(*) as _row", "text", "lang", "source")
    return judged(measured(rows), limits).filter("kept").select("_row.*")
