"""Blocking: keys by strategy, suppression of frequent keys, the join on keys, and the candidate pairs it gives.

All strategies are computed in one pass: a record yields its keys with the bit of their strategy, keys
are joined once, and the bits of a pair are or-ed. What one strategy finds is then a filter on its bit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.words import ADDRESS_STOPWORDS, NAME_STOPWORDS
from . import cells
from .normalize import fields


@dataclass(frozen=True)
class Blocking:
    """Settings of blocking; the defaults are the production ones."""

    strategies: tuple[str, ...] = ("exact_name", "name_token", "name_prefix", "address_conservative", "country_scoped_name")
    min_token_length: int = 3
    prefix_length: int = 4
    address_min_token_length: int = 4
    max_posting_list_size: int = 500
    country_agreement_mode: str = "allow_missing"
    name_stopwords: tuple[str, ...] = field(default=NAME_STOPWORDS)
    address_stopwords: tuple[str, ...] = field(default=ADDRESS_STOPWORDS)
    seed: int = 42

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict) -> Blocking:
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in cls.__dataclass_fields__})


#: A strategy makes an array of keys from a record's name, its word tokens, its address's and its country.
Strategy = Callable[[Blocking], Column]


def _significant(s: Blocking, least: int) -> Column:
    return F.filter("name_tokens", lambda t: (F.length(t) >= least) & ~t.isin(*s.name_stopwords))


def exact_name(s: Blocking) -> Column:
    return F.array(F.concat(F.lit("exact:"), "name"))


def name_token(s: Blocking) -> Column:
    return F.transform(_significant(s, s.min_token_length), lambda t: F.concat(F.lit("tok:"), t))


def name_prefix(s: Blocking) -> Column:
    return F.transform(_significant(s, s.prefix_length), lambda t: F.concat(F.lit(f"pre{s.prefix_length}:"), F.substring(t, 1, s.prefix_length)))


def address_conservative(s: Blocking) -> Column:
    """A street number with the word beside it, postal codes, and single words that tell something."""
    digits = lambda t: t.rlike(r"^\p{Nd}+$")
    tokens = F.col("address_tokens")

    def keys(t: Column, i: Column) -> Column:
        beside = F.when(i + 1 < F.size(tokens), F.get(tokens, i + 1)).otherwise(F.get(tokens, i - 1))
        partner = ~digits(beside) & ~beside.isin(*s.address_stopwords) & (F.length(beside) >= 3)
        return F.array(
            F.when(digits(t) & (F.length(t) <= 6) & partner, F.concat(F.lit("addr_num:"), t, F.lit("_"), beside)),
            F.when(digits(t) & F.length(t).isin(5, 6), F.concat(F.lit("addr_zip:"), t)),
            F.when(~digits(t) & (F.length(t) >= s.address_min_token_length) & ~t.isin(*s.address_stopwords), F.concat(F.lit("addr_tok:"), t)),
        )

    return F.array_compact(F.flatten(F.transform(tokens, keys)))


def country_scoped_name(s: Blocking) -> Column:
    place = F.when(F.col("country") == "", "unknown").otherwise(F.col("country"))
    words = F.transform(_significant(s, s.min_token_length), lambda t: F.concat(F.lit("c_tok:"), place, F.lit(":"), t))
    return F.concat(F.array(F.concat(F.lit("c_name:"), place, F.lit(":"), "name")), words)


STRATEGIES: dict[str, Strategy] = {f.__name__: f for f in (exact_name, name_token, name_prefix, address_conservative, country_scoped_name)}
ALIASES = {"address": "address_conservative", "address_token": "address_conservative", "country_aware": "country_scoped_name", "country_name": "country_scoped_name"}
#: Strategies that need no name.
NAMELESS = {"address_conservative"}


def register(name: str, strategy: Strategy, nameless: bool = False) -> None:
    """Adds a strategy of one's own; its keys need a prefix of their own."""
    STRATEGIES[name] = strategy
    if nameless:
        NAMELESS.add(name)


def strategies_of(name: str, s: Blocking | None = None) -> tuple[str, ...]:
    """The strategies behind a name: one, or all of the settings' for ``composite``."""
    plain = name.strip().lower()
    plain = ALIASES.get(plain, plain)
    if plain == "composite":
        return (s or Blocking()).strategies
    if plain not in STRATEGIES:
        raise ValueError(f"unknown strategy: {name}")
    return (plain,)


def _with_bit(bit: int) -> Callable[[Column], Column]:
    return lambda key: F.struct(key.alias("key"), F.lit(bit).alias("bit"))


def _with_letter(bit: int) -> Callable[[Column], Column]:
    return lambda key: F.concat(F.lit(chr(65 + bit)), key)


def keys(records: DataFrame, s: Blocking | None = None) -> DataFrame:
    """entity_id, country, key, bit: every distinct key of each record, with the bit of its strategy in the settings' order."""
    return keys_of(fields(records), s)


def keys_of(rows: DataFrame, s: Blocking | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """``keys`` of entity_id, name, address, country as blocking reads them; columns named in ``extra`` are kept."""
    s = s or Blocking()
    rows, arrays = _key_arrays(rows, s)
    arrays = [F.transform(made, _with_bit(1 << bit)) for bit, made in enumerate(arrays)]
    spread = rows.select("entity_id", *extra, "country", F.explode(F.concat(*arrays)).alias("k"))
    return spread.select("entity_id", *extra, "country", "k.key", "k.bit")


def _key_arrays(rows: DataFrame, s: Blocking) -> tuple[DataFrame, list[Column]]:
    """The rows with their tokens, and an array of distinct keys for each strategy."""
    rows = rows.withColumns({
        "name_tokens": text.word_tokens(F.col("name")), "address_tokens": text.word_tokens(F.col("address")),
    })
    arrays = []
    for name in s.strategies:
        made = STRATEGIES[name](s)
        if name not in NAMELESS:
            made = F.when(F.col("name") != "", made).otherwise(F.array().cast("array<string>"))
        arrays.append(F.array_distinct(made))
    return rows, arrays


def blocked(rows: DataFrame, tag: Column, s: Blocking | None = None) -> DataFrame:
    """``cells.blocks`` of entity_id, source (1: source 1), name, address, country (and about); equal tags mark pairs of interest."""
    s = s or Blocking()
    rows, arrays = _key_arrays(rows.withColumn("tag", tag), s)
    marked = [F.transform(made, _with_letter(bit)) for bit, made in enumerate(arrays)]
    more = [c for c in ("about",) if c in rows.columns]
    return cells.blocks(rows.select(F.col("entity_id").alias("id"), F.col("source").alias("side"), "country", "tag", F.concat(*marked).alias("keys"), *more), s.max_posting_list_size)


def targets(s2: DataFrame, s3: DataFrame, first: int | None = None) -> DataFrame:
    """Records of both sources with ``target_source``; ``first`` keeps so many, source 2 before source 3, in order of id (a sampling operator)."""
    both = s2.withColumn("target_source", F.lit("Source 2")).unionByName(s3.withColumn("target_source", F.lit("Source 3")))
    return both.orderBy("target_source", "entity_id").limit(first) if first else both


def target_keys(s2: DataFrame, s3: DataFrame, s: Blocking | None = None) -> DataFrame:
    """t, target_source, country, key, bit of all targets."""
    part = lambda r, n: keys(r, s).select(F.col("entity_id").alias("t"), F.lit(n).alias("target_source"), "country", "key", "bit")
    return part(s2, "Source 2").unionByName(part(s3, "Source 3"))


def posting_sizes(index: DataFrame) -> DataFrame:
    """key, bit, size: how many target rows have a key."""
    return index.groupBy("key", "bit").agg(F.count(F.lit(1)).alias("size"))


def suppressed(index: DataFrame, s: Blocking | None = None) -> DataFrame:
    """The keys with more postings than allowed."""
    return posting_sizes(index).where(F.col("size") > (s or Blocking()).max_posting_list_size)


def posting_stats(index: DataFrame, s: Blocking | None = None) -> DataFrame:
    """One row: active and suppressed keys, postings kept, the mean of active keys, the largest list before suppression."""
    most = (s or Blocking()).max_posting_list_size
    active = F.col("size") <= most
    return posting_sizes(index).agg(
        F.count_if(active).alias("active_keys"), F.count_if(~active).alias("suppressed_keys"), F.coalesce(F.sum(F.when(active, F.col("size"))), F.lit(0)).alias("postings"),
        F.avg(F.when(active, F.col("size"))).alias("mean_postings"), F.max("size").alias("largest"),
    )


def agreement(a: Column, b: Column, mode: str) -> Column:
    """Whether two countries agree."""
    if mode == "allow_missing":
        return (a == "") | (b == "") | (a == b)
    if mode == "strict":
        return (a != "") & (a == b)
    if mode == "none":
        return F.lit(True)
    raise ValueError(f"unknown country mode: {mode}")


def strategy_names(mask: Column, s: Blocking) -> Column:
    """The names of a mask's strategies, in order."""
    named = sorted((name, 1 << bit) for bit, name in enumerate(s.strategies))
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(b) != 0, name) for name, b in named]))


def kept_index(index: DataFrame, s: Blocking | None = None) -> DataFrame:
    """The key table of the targets without suppressed keys: no key of it has more rows than allowed."""
    return index.join(suppressed(index, s).select("key"), "key", "left_anti")


#: Records of source 1 that share a key and go to one task; more are dealt to several, each with the key's targets.
HOT = 100_000


def hot_keys(left: DataFrame) -> DataFrame:
    """key, parts: keys that more records of source 1 have than one task should join."""
    sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
    return sizes.select("key", F.ceil(F.col("n") / HOT).cast("int").alias("parts"))


def match(left: DataFrame, index: DataFrame, s: Blocking | None = None, hot: DataFrame | None = None) -> DataFrame:
    """s1, t, target_source, mask: pairs of ``keys`` of source 1 and a ``kept_index`` that share a key and whose countries agree.

    One key makes at most as many pairs for each record that has it as the index may have rows of it. ``hot``
    is the table of ``hot_keys`` of ``left``: their records are salted, and the few targets of such a key repeated.
    """
    s = s or Blocking()
    a = left.select(F.col("entity_id").alias("s1"), F.col("country").alias("c1"), "key", "bit")
    b = index.select("t", "target_source", F.col("country").alias("c2"), F.col("key").alias("key2"))
    on = (F.col("key") == F.col("key2")) & agreement(F.col("c1"), F.col("c2"), s.country_agreement_mode)
    if hot is not None:
        parts = F.coalesce("parts", F.lit(1))
        a = a.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("s1"), parts).cast("int")).drop("parts")
        b = b.join(hot.withColumnRenamed("key", "key2"), "key2", "left")
        b = b.withColumn("salt2", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        on = on & (F.col("salt") == F.col("salt2"))
    found = a.join(b, on)
    return found.groupBy("s1", "t").agg(F.max("target_source").alias("target_source"), F.bit_or("bit").alias("mask"))


def pairs(s1: DataFrame, s2: DataFrame, s3: DataFrame, s: Blocking | None = None) -> DataFrame:
    """``match`` of records; frequent keys are dropped from the index before rows meet."""
    left = keys(s1, s)
    return match(left, kept_index(target_keys(s2, s3, s), s), s)


def as_candidates(found: DataFrame, s: Blocking | None = None, ordered: bool = True) -> DataFrame:
    """Pairs with the names of the strategies that found them, in order of the ids if they are to be ``ordered``, which shuffles all of them."""
    names = strategy_names(F.col("mask"), s or Blocking()).alias("strategies")
    rows = found.select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), "target_source", names)
    return rows.orderBy("source1_entity_id", "target_entity_id") if ordered else rows


def candidates(s1: DataFrame, s2: DataFrame, s3: DataFrame, s: Blocking | None = None) -> DataFrame:
    """Candidate pairs with the names of the strategies that found them, in order of the ids."""
    return as_candidates(pairs(s1, s2, s3, s), s)
