"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Among all document rates in [0, cap] whose tokens meet the
targets, the rates closest in relative entropy to taking everything once are exponentially tilted:

    rate = cap * exp(t) / (cap - 1 + exp(t)),   t = the source's dual multiplier,

which is 1 at t = 0 and nears the cap as t grows. The multipliers maximise a concave dual; its
gradient and curvature per source are sums over documents, reduced where the documents are read,
so the Newton steps run on one row per source. Rates are then rounded into whole copies by draws
from each document's digest; of several such roundings each source takes the one whose words come
nearest to its target. Where even that one misses by more than an average document, as beside one
very long document, copies are dealt size class by size class instead, longest first, and each class
takes its rate from what is left of the target. Everything is repeatable, and a hot source is only
ever summed up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import SPACED, fresh
from tidemark.llm.quality import bucket
from tidemark.session import staged

WEIGHTS = (5, 2, 1)
CAP = 3
#: Rates are rounded to this grid, so copies follow from whole numbers alone.
GRID = 1 << 20
#: Ways of rounding tried per source; the one whose words come nearest to the target is taken.
TRIES = 128
#: Parts into which the documents of a size class are dealt by digest; a class rounds up whole parts.
PARTS = 1024
#: The table of sources is broadcast up to this many rows; beyond it, joined like any table.
MAX_BROADCAST_SOURCES = 20_000
NEWTON_STEPS = 60


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with _size (words), _tie (digest of id, source and text) and _key.

    _key is never null and sorts as the source does in code point order, null last.
    """
    return docs.selectExpr(
        *[f"`{c}`" for c in docs.columns],
        rf"cast(regexp_count(coalesce(text, ''), r'{SPACED}') as bigint) as _size",
        "md5(concat_ws('|', coalesce(cast(doc_id as string), 'null'), coalesce(source, ''), "
        "coalesce(text, ''))) as _tie",
        "coalesce(concat('s', source), 't') as _key",
    )


# In try k a document draws (a + k * b) mod GRID, a and b from its digest, and rounds its rate up
# where the draw carries it over the next whole number.
_DRAWS = ("cast(conv(substr(_tie, 1, 5), 16, 10) as bigint) as _a",
          "cast(conv(substr(_tie, 6, 5), 16, 10) as bigint) * 2 + 1 as _b")
_ROUNDED = f"((_step + (_a + _try * _b) % {GRID}) div {GRID})"


def source_targets(totals: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(_key, source_size, weight, target) from (_key, source_size), one row per source.

    Weights repeat over the sources in code point order, null last. Targets share the total by
    weight; a target stops at ``cap`` times its source's size and what it leaves is shared again.
    That ends at min(cap * size, weight * level) with one level for all: each round fixes the
    sources that the current level fills and takes the level anew, from two sums per round.
    """
    cycle = ", ".join(map(str, weights))
    weighed = staged(totals.selectExpr(
        "*", f"array({cycle})[cast((row_number() over (order by _key) - 1) % "
             f"{len(weights)} as int)] as weight",
    ))
    level = None
    while True:
        full = "false" if level is None else f"{cap} * source_size <= weight * {level!r}d"
        sums = weighed.agg(
            F.expr("sum(source_size)").alias("total"),
            F.expr(f"sum(if({full}, {cap} * source_size, 0))").alias("fixed"),
            F.expr(f"sum(if({full}, 0, weight))").alias("weight"),
        ).first()
        if not sums.weight:
            break
        following = float(sums.total - sums.fixed) / float(sums.weight)
        if level is not None and following <= level:
            break
        level = following
    share = "0d" if level is None else f"weight * {level!r}d"
    return weighed.selectExpr("*", f"least(double({cap} * source_size), {share}) as target")


def balanced(targets: DataFrame, cap: int = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """``targets`` with the dual multiplier ``tilt`` and the document rate ``rate``.

    Newton's iteration on target = size * rate(tilt), for all sources at once inside the plan. A
    step longer than 2 is shortened, which keeps it from overshooting where the curve is flat. A
    source whose target is its cap has the limit rate of an infinite tilt; an empty one has 1.
    """
    rate = f"({cap}d * exp(t) / ({cap - 1}d + exp(t)))"
    newton = (
        f"(t, i) -> t - greatest(-2d, least(2d, (source_size * {rate} - target) / "
        f"greatest(1e-300, source_size * {rate} * (1d - {rate} / {cap}d))))"
    )
    return targets.selectExpr(
        "*",
        f"case when source_size = 0 then 0d when target >= {cap}d * source_size then "
        "double('infinity') when target <= 0 then double('-infinity') else "
        f"aggregate(sequence(1, {steps}), 0d, {newton}) end as tilt",
    ).selectExpr(
        "*", f"case when tilt = double('infinity') then {cap}d "
             f"else {cap}d * exp(tilt) / ({cap - 1}d + exp(tilt)) end as rate",
    )


_CLASS = f"{bucket('_size')} as _class"
_PART = f"_a div {GRID // PARTS}"


def dealt(narrow: DataFrame, missed: DataFrame, cap: int = CAP) -> DataFrame:
    """(_key, _class, _base, _upto): copies for the sources ``missed``, longest documents first.

    A class is a sketch bucket of sizes, so its documents differ by 1/16 at most. Its documents
    get _base copies and those in parts under _upto one more. Per class, the rate is what is left
    of the target over what is left of the source; of all _upto the one nearest to that rate is
    taken among those after which copies in 0..cap of shorter documents can still meet the target,
    or else come nearest to it. What a class misses, the next ones make good. Sources that the
    best draw brings nearer are left out.

    Documents are only summed up per class and part; a source is then one row of at most PARTS
    sums for each of its classes.
    """
    sums = (
        narrow.filter("_size > 0").join(missed.select("_key"), "_key", "left_semi")
        .selectExpr("_key", "_size", _CLASS, *_DRAWS).selectExpr("*", f"{_PART} as _part")
        .groupBy("_key", "_class", "_part").agg(F.sum("_size").alias("_sum"))
    )
    by_class = sums.selectExpr(
        "_key", "_class", "_sum", "named_struct('upto', _part + 1, 'size', "
        "sum(_sum) over (partition by _key, _class order by _part)) as _upto",
    ).groupBy("_key", "_class").agg(
        F.sum("_sum").alias("_sum"), F.sort_array(F.collect_list("_upto")).alias("_upto"))
    by_source = by_class.groupBy("_key").agg(F.expr(
        "reverse(array_sort(collect_list(struct(_class, _sum, _upto)))) as _classes"
    )).join(missed.select("_key", "source_size", "target", "_away"), "_key")
    # For a class c and the state s before it: the rate, then the best of its cuts.
    rate = f"greatest(0d, least({cap}d, s.left / s.size))"
    after = "s.left - b * c._sum - u.size"
    cut = (
        f"struct(greatest(0d, -({after}), {after} - {cap}d * (s.size - c._sum)) as off, "
        f"abs(u.size - (r - b) * c._sum) as away, u.upto as upto, u.size as size)"
    )
    cuts = (
        "concat(array(named_struct('upto', 0L, 'size', 0L)), "
        f"if(b < {cap}, c._upto, slice(c._upto, 1, 0)))"
    )
    step = (
        f"(s, c) -> transform(array({rate}), r -> transform(array(cast(floor(r) as bigint)), b -> "
        f"transform(array(array_min(transform({cuts}, u -> {cut}))), x -> named_struct("
        "'left', s.left - b * c._sum - x.size, 'size', s.size - c._sum, "
        "'plan', concat(s.plan, array(struct(c._class as _class, b as _base, x.upto as _upto)))"
        "))[0])[0])[0]"
    )
    start = (
        "named_struct('left', target, 'size', source_size, 'plan', "
        "cast(array() as array<struct<_class: bigint, _base: bigint, _upto: bigint>>))"
    )
    return by_source.selectExpr("_key", "_away", f"aggregate(_classes, {start}, {step}) as _end") \
        .filter("abs(_end.left) < _away").selectExpr("_key", "inline(_end.plan)")


def copies(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, tries: int = TRIES) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, rate, copies and taken.

    taken = size * copies, with copies in 0..cap, so no document exceeds cap times its size.
    Columns of docs with these names are replaced. Null text has size 0; a null source is one
    source, last in order. Rows equal in id, source and text get equal copies. An empty table
    gives an empty table. Texts are not shuffled while the per-source table can be broadcast.
    """
    docs = fresh(docs, "size", "source_size", "target", "rate", "copies", "taken")
    narrow = staged(sized(docs).select("_key", "_size", "_tie"))
    totals = narrow.groupBy("_key").agg(
        F.sum("_size").alias("source_size"), F.expr("count_if(_size > 0) as _docs"))
    rates = staged(balanced(source_targets(totals, weights, cap), cap).selectExpr(
        "_key", "source_size", "_docs", "target", "rate",
        f"cast(round(rate * {GRID}) as bigint) as _step"
    ))
    small = rates.count() <= MAX_BROADCAST_SOURCES
    held = F.broadcast if small else (lambda table: table)
    tried = (
        narrow.join(held(rates), "_key")
        .selectExpr("_key", "target", "_size", "_step", *_DRAWS,
                    f"explode(sequence(0, {tries - 1})) as _try")
        .groupBy("_key", "_try")
        .agg(F.expr(f"abs(sum(_size * {_ROUNDED}) - max(target)) as _away"))
    )
    best = tried.groupBy("_key").agg(F.expr("min(struct(_away, _try)) as _best"))
    chosen = staged(rates.join(best, "_key").selectExpr("*", "_best._try", "_best._away"))
    rows = sized(docs).join(held(chosen), "_key").selectExpr("*", *_DRAWS)
    drawn = _ROUNDED
    missed = chosen.filter("_away * _docs > source_size")
    if not missed.isEmpty():
        plan = staged(dealt(narrow, missed, cap))
        few = plan.count() <= MAX_BROADCAST_SOURCES
        rows = rows.selectExpr("*", _CLASS).join(
            F.broadcast(plan) if few else plan, ["_key", "_class"], "left")
        drawn = f"coalesce(_base + if({_PART} < _upto, 1, 0), {_ROUNDED})"
    return rows.selectExpr(
        *[f"`{c}`" for c in docs.columns], "_size as size", "source_size", "target", "rate",
        f"{drawn} as copies",
    ).selectExpr("*", "size * copies as taken")


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its copies say, unchanged."""
    rows = docs.selectExpr("struct(*) as _row", "doc_id", "text", "source")
    chosen = copies(rows, weights, cap).filter("copies > 0")
    return chosen.selectExpr("_row", "explode(sequence(1, cast(copies as int)))").select("_row.*")
