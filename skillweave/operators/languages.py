"""The language of a text by ranked profiles of character trigrams, and the language a row gets when its text tells none.

A profile is a language's most frequent trigrams in order. A text's distance to it is the sum of the ranks there of all of the text's
trigrams, with PROFILE_SIZE for one that the profile lacks; the nearest profile is the language. The sum is made of what each
occurrence saves against a missing one, so trigrams meet the profiles where they stand and only sums are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LANGUAGES = ("de", "en", "es", "fr")
PROFILE_SIZE = 400
#: Of a text's trigrams, so many in a hundred have to be in the profile; else the text is of no language that is known.
LEAST_KNOWN = 30
#: The language of posts and profiles of a country.
COUNTRY_LANGUAGES = {"United Kingdom": "en", "Netherlands": "nl", "Nederland": "nl", "Germany": "de", "Deutschland": "de", "Spain": "es", "France": "fr", "Italy": "it", "Italia": "it", "Russia": "ru", "Россия": "ru"}


def trigrams(text: Column) -> Column:
    """All trigrams of a text's letters in lower case, with one blank for whatever stands between words and one at both
    ends; null when it has no letters."""
    words = F.nullif(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(""))
    chars = F.split(F.concat(F.lit(" "), words, F.lit(" ")), "")
    # the characters are bound once; in one expression each trigram would split the text anew
    return F.transform(F.array(chars), lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(c[i], c[i + 1], c[i + 2])))[0]


def profiles(rows: DataFrame, text: str = "text", lang: str = "lang", languages: tuple[str, ...] = LANGUAGES, size: int = PROFILE_SIZE) -> DataFrame:
    """lang, gram, place (from 0): the trigrams that the texts of each language hold most often, the first by character order of
    equally frequent ones. At most len(languages) * size rows. Rows of other languages and null texts count nowhere."""
    grams = rows.filter(F.col(lang).isin(*languages)).select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram"))
    counts = grams.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("place", place).filter(F.col("place") < size).select("lang", "gram", "place")


def detected(rows: DataFrame, keys: list[str], text: str, known: DataFrame, size: int = PROFILE_SIZE, least_known: int = LEAST_KNOWN) -> DataFrame:
    """keys, language: of the nearest profile, the first by name of equally near ones. Null where a text is null, has no letters or
    less than least_known percent of its trigrams in the profile. Rows of equal keys (nulls equal) are one text in several parts.

    The profiles are broadcast: `profiles` bounds them by the number of languages and their size."""
    saved = known.select("gram", F.col("lang").alias("__lang"), (F.lit(size) - F.col("place")).alias("__saved"))
    grams = rows.select(*keys, F.explode_outer(trigrams(F.col(text))).alias("gram"))
    # a trigram of several profiles is one row with what it saves in each, so the number of a text's trigrams can be summed beside
    table = saved.groupBy("gram").agg(F.collect_list(F.struct("__lang", "__saved")).alias("__in"))
    hits = grams.join(F.broadcast(table), "gram", "left").withColumn("__total", F.col("gram").isNotNull().cast("long"))
    sums = hits.withColumn("__one", F.explode(F.concat(F.array(F.struct(F.lit(None).cast("string").alias("__lang"), F.lit(0).alias("__saved"))), F.coalesce("__in", F.array()))))
    by_language = sums.groupBy(*keys, F.col("__one.__lang").alias("__lang")).agg(F.sum("__one.__saved").alias("__saved"), F.count(F.lit(1)).alias("__hits"), F.sum("__total").alias("__total"))
    named = F.col("__lang").isNotNull()
    # of equal savings the first name: a struct's least is taken of (-saved, name)
    best = F.min(F.when(named, F.struct((-F.col("__saved")).alias("s"), F.col("__lang").alias("l"), F.col("__hits").alias("h"))))
    told = by_language.groupBy(*keys).agg(best.alias("__best"), F.max(F.when(~named, F.col("__total"))).alias("__n"))
    return told.select(*keys, F.when(F.col("__best.h") * 100 >= least_known * F.col("__n"), F.col("__best.l")).alias("language"))


def assigned(rows: DataFrame, keys: list[str], text: str, known: DataFrame, country: str | None = None, default: str | None = None, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """keys, language of each text; else that of its country (one of the keys, whatever its case), else the default. Without a default,
    as for profiles, rows whose language is still unknown go; with one, as for posts, all rows stay."""
    out = detected(rows, keys, text, known)
    of_country = F.lit(None).cast("string")
    if country is not None:
        name = F.lower(F.trim(country))
        of_country = F.coalesce(*[F.when(name == k.lower(), F.lit(v)) for k, v in COUNTRY_LANGUAGES.items()])
    out = out.withColumn("language", F.coalesce(F.when(F.col("language").isin(*languages), F.col("language")), of_country, F.lit(default)))
    return out.filter(F.col("language").isNotNull())
