"""Learned tables: corpus statistics, vocabulary, gazetteer, transliteration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.lexicon import NOT_PLACE, STREET_TYPES
from kinweave.functions.text import any_of, clean_native_token, has_native, words

#: Words of the vocabulary and their least count; least counts of a city and of a mined state, and its share at the end.
VOCABULARY, LEAST_WORD, LEAST_CITY, LEAST_STATE, LAST_SHARE = 300_000, 3, 3, 30, 0.5


def token_idf(records: DataFrame) -> DataFrame:
    """(token, df, idf): idf is ln(records / records with the word)."""
    n = records.agg(F.count("*").alias("n"))
    df = records.select(F.explode(F.array_distinct(words(F.col("name_core")))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("token", "df", F.round(F.log(F.col("n") / F.col("df")), 6).alias("idf"))  # one row is broadcast


def key_counts(records: DataFrame) -> DataFrame:
    return records.where("name_key <> ''").groupBy("country", "name_key").agg(F.count("*").alias("n"))


def place_counts(records: DataFrame) -> DataFrame:
    return records.where("house_num <> ''").groupBy("house_num", "street").agg(F.count("*").alias("n"))


def vocabulary(names: DataFrame, column: str, most: int = VOCABULARY, least: int = LEAST_WORD) -> DataFrame:
    """(token, n): the most frequent words, ties by word."""
    clean = F.regexp_replace(F.regexp_replace(F.lower(column), "'", ""), "[^a-z0-9 ]+", " ")
    counts = names.select(F.explode(words(clean)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(most)


def place_parts(records: DataFrame, part: Column) -> DataFrame:
    """(country, name, n, last): how often a part without digits occurs, and how often as the last of its address.

    ``part`` normalizes one part; it is applied to each distinct part once.
    """
    country = F.coalesce(F.nullif(F.lower(F.trim("country")), F.lit("")), F.lit("unknown"))
    raw = F.filter(F.transform(F.split("business_address", ","), lambda p: F.trim(p)), lambda p: p != "")
    long = records.select(country.alias("country"), F.size(raw).alias("k"), F.posexplode(raw).alias("i", "raw")).where(~F.col("raw").rlike(r"\d"))
    grouped = long.groupBy("country", "raw").agg(F.count("*").alias("n"), F.sum((F.col("i") == F.col("k") - 1).cast("int")).alias("last"))
    named = grouped.withColumn("name", part).where((F.col("name") != "") & (F.size(words(F.col("name"))) <= 4))
    named = named.where(~F.arrays_overlap(words(F.col("name")), F.array(*map(F.lit, sorted(set(NOT_PLACE))))))
    return named.groupBy("country", "name").agg(F.sum("n").alias("n"), F.sum("last").alias("last"))


def mine_states(parts: DataFrame, tabled: list[str], least: int = LEAST_STATE) -> DataFrame:
    """States of countries without a state table: frequent and mostly last."""
    last_word = F.element_at(words(F.col("name")), -1)
    return parts.where(~any_of(F.col("country"), tabled) & (F.col("n") >= least) & (F.col("last") / F.col("n") >= LAST_SHARE) & ~any_of(last_word, STREET_TYPES)).select("country", "name")


def mine_cities(parts: DataFrame, states: DataFrame, least: int = LEAST_CITY) -> DataFrame:
    first, last = (F.element_at(words(F.col("name")), i) for i in (1, -1))
    return parts.where((F.col("n") >= least) & ~any_of(first, STREET_TYPES) & ~any_of(last, STREET_TYPES)).join(states, ["country", "name"], "left_anti").select("country", "name", "n")


def aligned_tokens(twins: DataFrame) -> DataFrame:
    """(native, latin) of names with as many native as Latin words; ``twins`` has native and latin names of one entity."""
    a = F.filter(F.transform(F.split("native", r"\s+"), clean_native_token), lambda w: w != "")
    b = words(F.regexp_replace(F.lower("latin"), "[^a-z0-9 ]+", " "))
    zipped = twins.select(a.alias("a"), b.alias("b")).where(F.size("a") == F.size("b"))
    return zipped.select(F.explode(F.arrays_zip("a", "b")).alias("z")).select(F.col("z.a").alias("native"), F.col("z.b").alias("latin")).where(has_native(F.col("native")))


def learn_tokens(twins: DataFrame) -> DataFrame:
    """(native, latin): each native word's commonest Latin twin, if it has two fifths of the word's records and is seen twice, or the word once."""
    seen = twins.select(F.explode(F.array_distinct(F.filter(F.transform(F.split("native", r"\s+"), clean_native_token), has_native))).alias("native")).groupBy("native").agg(F.count("*").alias("total"))
    counted = aligned_tokens(twins).groupBy("native", "latin").agg(F.count("*").alias("k"))
    best = counted.withColumn("r", F.row_number().over(Window.partitionBy("native").orderBy(F.desc("k"), "latin"))).where("r = 1").join(seen, "native")
    return best.where((F.col("k") / F.col("total") >= 0.4) & ((F.col("k") >= 2) | (F.col("total") == 1))).select("native", "latin")


def learn_parts(twins: DataFrame, least: int = 2, score: float = 0.05) -> DataFrame:
    """(native, latin): address parts that go together: the Latin part with the highest k² / (count · count).

    ``twins`` has native_parts and latin_parts, arrays of one record; their product is the record's own.
    """
    long = twins.select(F.explode(F.array_distinct("native_parts")).alias("native"), "latin_parts").select("native", F.explode(F.array_distinct("latin_parts")).alias("latin"))
    k = long.groupBy("native", "latin").agg(F.count("*").alias("k"))
    a = twins.select(F.explode(F.array_distinct("native_parts")).alias("native")).groupBy("native").agg(F.count("*").alias("ca"))
    b = twins.select(F.explode(F.array_distinct("latin_parts")).alias("latin")).groupBy("latin").agg(F.count("*").alias("cb"))
    scored = k.where(F.col("k") >= least).join(a, "native").join(b, "latin").withColumn("s", F.col("k") * F.col("k") / (F.col("ca") * F.col("cb"))).where(F.col("s") >= score)
    return scored.groupBy("native").agg(F.max_by("latin", F.struct("s", "k", "latin")).alias("latin"))


def transliterate(df: DataFrame, column: str, key: str, learned: DataFrame) -> DataFrame:
    """(key, text, n_native, n_learned): native words by the learned table (native, latin), the rest as they are."""
    long = df.select(key, F.posexplode(F.split(F.coalesce(F.col(column), F.lit("")), " ")).alias("i", "w")).withColumn("native", F.when(has_native(F.col("w")), clean_native_token(F.col("w"))))
    met = long.join(learned, "native", "left").withColumn("out", F.coalesce("latin", "w"))
    return met.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "out"))), lambda x: x["out"]), " ").alias("text"),
        F.count("native").alias("n_native"),
        F.count("latin").alias("n_learned"),
    )
