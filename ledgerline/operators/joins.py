"""Join shapes.  The algorithm is always left to Spark: no side is broadcast by hand here.

Spark's own size check (and adaptive execution at run time) turns a join with a small side
into a broadcast join, and splits skewed partitions of the others.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.functions.text import contains_any
from ledgerline.operators.columns import quoted
from ledgerline.session import settled

_SALTS = 1 << 30  # more than any number of partitions
_SALT = "__null_salt"


def _all(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def require_new(columns: Sequence[str], taken: Collection[str]) -> None:
    if clash := [c for c in columns if c in taken]:
        raise ValueError(f"columns on both sides: {clash}")


def spread(struct: str, columns: Sequence[str]) -> dict[str, Column]:
    """The fields of a struct column, null where it is null.

    The struct is asked for as a whole; the optimizer would take single fields below the joins.
    """
    whole = F.when(quoted(struct).isNotNull(), quoted(struct))
    return {c: whole.getField(c) for c in columns}


def null_safe_left_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Left join in which rows with a null key part do not pile up in one partition.

    Such rows cannot match.  In one pass they get a salt from their other columns, so a shuffle
    spreads them over all partitions, while rows with full keys all carry salt 0, as the right
    side does.  Keys that the schema declares never null need no salt, and there the join keeps
    a partitioning by its keys.  Columns keep the order left then right, with one copy of the keys.
    ``how`` may also be ``left_anti``: rows without a partner, those with a null key part included.
    """
    return _null_safe_joins(left, [right], pairs, how)


def null_safe_left_joins(
    left: DataFrame, rights: Sequence[DataFrame], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """:func:`null_safe_left_join` with several tables on the same keys, one after the other.

    The salt is worked out once, so all joins share one exchange and one sort of the left rows.
    """
    return _null_safe_joins(left, rights, pairs, "left")


def _null_safe_joins(
    left: DataFrame, rights: Sequence[DataFrame], pairs: Sequence[tuple[str, str]], how: str
) -> DataFrame:
    keys = {r for _, r in pairs}
    others = [c for c in left.columns if c not in {l for l, _ in pairs}] or left.columns
    taken, dropped = set(left.columns), [_SALT]
    salted = any(left.schema[l].nullable for l, _ in pairs)
    if salted:
        incomplete = reduce(lambda a, b: a | b, [quoted(l).isNull() for l, _ in pairs])
        spread = F.pmod(F.xxhash64(*[quoted(c) for c in others]), F.lit(_SALTS))
        left = left.withColumn(_SALT, F.when(incomplete, 1 + spread).otherwise(F.lit(0)).cast("int"))
    for n, right in enumerate(rights):
        brought = [c for c in right.columns if how == "left" and c not in keys]
        require_new(brought, taken)
        taken.update(brought)
        names = [f"__key{n}_{i}" for i in range(len(pairs))]
        keyed = right.select(
            *[quoted(r).alias(name) for name, (_, r) in zip(names, pairs, strict=True)], *[quoted(c) for c in brought]
        )
        equal = [quoted(l) == F.col(name) for name, (l, _) in zip(names, pairs, strict=True)]
        if salted:
            # always 0, but not a literal: the optimizer would turn that into a filter on the left
            zero = F.xxhash64(*[F.col(name) for name in names]).bitwiseAND(F.lit(0))
            keyed = keyed.withColumn(f"__salt{n}", zero.cast("int"))
            equal.append(F.col(_SALT) == F.col(f"__salt{n}"))
        left = left.join(keyed, _all(equal), how)
        dropped += [*names, f"__salt{n}"]
    return left.drop(*dropped)


@dataclass(frozen=True)
class Dimension:
    """One arm of a star: the dimension, its key, the fact's key and the columns to bring."""

    table: DataFrame
    key: str
    fact_key: str
    columns: dict[str, str] = field(default_factory=dict)

    def selected(self) -> DataFrame:
        return self.table.select(
            quoted(self.key).alias(self.fact_key),
            *[quoted(source).alias(name) for name, source in self.columns.items()],
        )


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Fact with each dimension's chosen columns; every fact row is kept once per dimension key."""
    for dimension in dimensions:
        fact = null_safe_left_join(
            fact, dimension.selected(), [(dimension.fact_key, dimension.fact_key)]
        )
    return fact


def enrich(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
) -> DataFrame:
    """Equi-join on differently named keys with one copy of them."""
    if how == "left":
        return null_safe_left_join(left, right, pairs)
    keyed = right.withColumnsRenamed({r: f"__key{i}" for i, (_, r) in enumerate(pairs)})
    condition = _all([quoted(l) == F.col(f"__key{i}") for i, (l, _) in enumerate(pairs)])
    return left.join(keyed, condition, how).drop(*[f"__key{i}" for i in range(len(pairs))])


def upsert(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows plus the old ones whose key is not among them."""
    return new.unionByName(old.join(new.select(key), key, "left_anti").select(new.columns))


def missing_members(df: DataFrame, having: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows whose key does not occur in ``having``."""
    return df.join(having.select(*keys), list(keys), "left_anti").dropDuplicates()


def merge_metric_sets(sets: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer merge of metric tables that share one key."""
    return reduce(lambda a, b: a.join(b, key, "outer"), sets)


def attach_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key; without keys ``totals`` is one row, read as a scalar by every row."""
    if keys:
        return null_safe_left_join(df, totals, [(k, k) for k in keys])
    return df.select(
        "*", *[totals.select(quoted(c)).scalar().alias(c) for c in totals.columns]
    )


def containment_flag(
    df: DataFrame, column: str, tokens: list[str] | DataFrame, flag: str
) -> DataFrame:
    """True where the text contains a token, ignoring case; rows are never multiplied.

    A list written in the job becomes one expression.  A token table is matched through an index
    of words: a token's longest run of characters other than blanks must lie inside a word of the
    text, so only the distinct words of all texts are cut into pieces, texts are exploded into
    their distinct words, and tokens of several runs are verified on the texts that hold such a
    word.  Texts travel as ids.  A null text contains nothing, and an empty token is in no text.
    """
    if not isinstance(tokens, DataFrame):
        return df.withColumn(flag, contains_any(quoted(column), tokens))
    runs = F.regexp_extract_all(F.col("token"), F.lit(r"(\S+)"), F.lit(1))
    longest = F.aggregate(
        runs, F.lit(""), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a)
    )
    needles = (
        tokens.select(F.upper(quoted(tokens.columns[0])).alias("token"))
        .filter("token != ''")
        .distinct()
        .withColumn("part", F.when(F.size(runs) > 0, longest).otherwise(F.col("token")))
    )
    lengths = sorted(
        r[0] for r in needles.select(F.length("part")).distinct().collect()
    )  # distinct token lengths, a handful
    if not lengths:
        return df.withColumn(flag, F.lit(False))
    texts = settled(
        df.select(quoted(column).alias("text"))
        .filter("text is not null")
        .distinct()
        .withColumn("text_id", F.monotonically_increasing_id())
    )
    upper = F.upper(F.col("text"))
    found = F.regexp_extract_all(upper, F.lit(r"(\S+|\s+)"), F.lit(1))
    words = settled(texts.select("text_id", F.explode(F.array_distinct(found)).alias("word")))

    def windows(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("word") - n + 1)
        return F.when(
            F.length("word") >= n, F.transform(starts, lambda i: F.substring("word", i, F.lit(n)))
        ).otherwise(F.array().cast("array<string>"))

    pieces = F.array_distinct(F.flatten(F.array(*[windows(n) for n in lengths])))
    holding = settled(
        words.select("word")
        .distinct()
        .select("word", F.explode(pieces).alias("part"))
        .join(needles.select("part").distinct(), "part", "left_semi")
    )
    plain = holding.join(needles.filter("token = part"), "part", "left_semi").select("word").distinct()
    several = holding.join(needles.filter("token != part"), "part").select("word", "token")
    certain = words.join(plain, "word", "left_semi").select("text_id")
    verified = (
        words.join(several, "word")
        .select("text_id", "token")
        .distinct()
        .join(texts, "text_id")
        .filter(F.contains(upper, F.col("token")))
        .select("text_id")
    )
    hits = texts.join(certain.unionByName(verified), "text_id", "left_semi").select(
        F.col("text").alias("__text"), F.lit(True).alias(flag)
    )
    joined = null_safe_left_join(df, hits, [(column, "__text")])
    return joined.withColumn(flag, F.coalesce(quoted(flag), F.lit(False)))


def members_of(df: DataFrame, key: str, elements: str) -> DataFrame:
    """Sets held in an array column as distinct (key, element) rows."""
    return df.select(
        quoted(key), F.explode(F.array_distinct(quoted(elements))).alias("element")
    )


def set_classes(rows: DataFrame) -> DataFrame:
    """(``set_id``, ``class_id``, ``members``) per set of distinct (``set_id``, ``element``) rows.

    Equal sets share the smallest id among them as their class.  They are told by their size and
    128 bits of their elements' hashes, so no set is gathered; copies of one set, however many,
    are joined to the one row of their class.
    """
    prints = rows.groupBy("set_id").agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("element")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("second"), "element")).alias("b"),
    )
    first = prints.groupBy("members", "a", "b").agg(F.min("set_id").alias("class_id"))
    return settled(prints.join(first, ["members", "a", "b"]).select("set_id", "class_id", "members"))


def _rarest(wanted: DataFrame, frequency: DataFrame) -> DataFrame:
    """(``small``, ``members``, ``first``, ``second``): the two rarest elements of every small set
    whose elements all occur; ``second`` is null in sets of one element."""
    order = Window.partitionBy("small").orderBy("sets", "element")
    ranked = wanted.join(frequency, "element").withColumn("n", F.row_number().over(order))
    whole = F.count("*") == F.first("members")
    return (
        ranked.groupBy("small")
        .agg(
            F.first("members").alias("members"),
            F.max(F.when(F.col("n") == 1, F.col("element"))).alias("first"),
            F.max(F.when(F.col("n") == 2, F.col("element"))).alias("second"),
            whole.alias("whole"),
        )
        .filter("whole")
        .drop("whole")
    )


def subset_pairs(small: DataFrame, large: DataFrame, small_id: str, large_id: str) -> DataFrame:
    """All pairs whose small set lies inside the large set; sets are (id, ``element``) rows.

    Equal sets are compared once, as classes, and spread out at the end.  A small set can only lie
    inside sets that hold its two rarest elements, so candidates are the large sets that hold such
    a pair, looked up once per distinct pair: an element that nearly every set has (a client
    number, a language) never multiplies candidates by itself unless it is all a set consists of.
    Candidates of sets of three and more elements are verified by counting the small set's other
    elements found in the large one, as narrow rows of ids.  No set is ever gathered in one place;
    tables that several joins read are written down.  An empty small set has no rows and pairs
    with nothing.
    """
    held_rows = settled(large.select(quoted(large_id).alias("set_id"), "element").distinct())
    wanted_rows = settled(small.select(quoted(small_id).alias("set_id"), "element").distinct())
    large_sets, small_sets = set_classes(held_rows), set_classes(wanted_rows)

    def of_classes(rows: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        chosen = sets.filter("set_id = class_id").select("set_id", "members")
        return settled(rows.join(chosen, "set_id").withColumnRenamed("set_id", name))

    held = of_classes(held_rows, large_sets, "large").withColumnRenamed("members", "size")
    wanted = of_classes(wanted_rows, small_sets, "small")
    frequency = held.groupBy("element").agg(F.count("*").alias("sets"))
    rarest = settled(_rarest(wanted, frequency))

    single = rarest.filter("second is null").select("small", F.col("first").alias("element"))
    found = single.join(held, "element").select("small", "large")
    both = rarest.filter("second is not null").select("first", "second").distinct()
    holding = (
        both.join(held.withColumnRenamed("element", "first"), "first")
        .join(held.select("large", F.col("element").alias("second")), ["large", "second"], "left_semi")
        .select("first", "second", "large", "size")
    )
    candidates = settled(
        rarest.join(holding, ["first", "second"])
        .filter("members <= size")
        .select("small", "large", "members")
    )
    others = (
        wanted.filter("members > 2")
        .select("small", "element")
        .join(rarest.select("small", "first", "second"), "small")
        .filter("element not in (first, second)")
        .select("small", "element")
    )
    verified = (
        candidates.filter("members > 2")
        .join(others, "small")
        .join(held.select("large", "element"), ["large", "element"], "left_semi")
        .groupBy("small", "large", "members")
        .agg(F.count("*").alias("hits"))
        .filter("hits = members - 2")
        .select("small", "large")
    )
    pairs = found.unionByName(candidates.filter("members = 2").select("small", "large")).unionByName(verified)
    same = small_id == large_id
    of_small = small_sets.select(
        F.col("class_id").alias("small"), F.col("set_id").alias(f"small_{small_id}" if same else small_id)
    )
    of_large = large_sets.select(
        F.col("class_id").alias("large"), F.col("set_id").alias(f"large_{large_id}" if same else large_id)
    )
    return pairs.join(of_small, "small").join(of_large, "large").drop("small", "large")


def partner_columns(
    relations: DataFrame,
    names: DataFrame,
    owner: str,
    partner: str,
    role: str,
    roles: Sequence[str],
) -> DataFrame:
    """One row per owner with each role's partner key and name.

    One grouping takes every role at once; where an owner has several partners in a role the
    smallest key stands for them.
    """
    chosen = (
        relations.filter(quoted(role).isin(list(roles)))
        .groupBy(quoted(owner).alias("owner"), quoted(role).alias("role"))
        .agg(F.min(quoted(partner)).alias("partner"))
    )
    named = null_safe_left_join(
        chosen, names.select(F.col("primary_key"), F.col("name")), [("partner", "primary_key")]
    )
    return named.groupBy(F.col("owner").alias("primary_key")).agg(
        *[
            F.max(F.when(F.col("role") == r, F.col(source))).alias(f"partner_{kind}_{r}")
            for r in roles
            for kind, source in (("key", "partner"), ("name", "name"))
        ]
    )


def prefer_right(
    left: DataFrame, right: DataFrame, key: str, attribute: str, output: str
) -> DataFrame:
    """Left join; the right side's attribute counts first, the left one's where it has none."""
    other = right.withColumnRenamed(attribute, "__other")
    joined = null_safe_left_join(left, other, [(key, key)])
    return joined.withColumn(output, F.coalesce("__other", quoted(attribute))).drop("__other")


def membership_flag(df: DataFrame, column: str, listed: DataFrame, listed_column: str, flag: str) -> DataFrame:
    """True where the value occurs in the listed table; duplicates there do not multiply rows."""
    keys = (
        listed.select(quoted(listed_column).alias("__listed"))
        .filter("__listed is not null")
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    joined = null_safe_left_join(df, keys, [(column, "__listed")])
    return joined.withColumn(flag, F.coalesce(quoted(flag), F.lit(False)))
