"""Salary and phrase extraction, near-duplicate pairs, regions, clustering."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions.text import clean
from skillweave.functions.text import let as _let
from skillweave.session import work_folder

_AMOUNT = r"(\d{1,3}(?:[,.'’]\d{3})+|\d+)(\.\d{1,2})?\s?(k)?"
#: A period may also stand between the two amounts of a range.
_EACH = r"(?:\s?(?:p[./]?[hda]|(?:per|an?|/)\s?(?:hour|day|week|month|year|annum))\b)?"
#: One amount, or a range of two; what follows is looked at for the period and for amounts that are no salaries.
SALARY = rf"(?is)[£$€]\s?{_AMOUNT}(?:{_EACH}\s?(?:-|–|to|and)\s?[£$€]?\s?{_AMOUNT})?(?!\d)(?=(.{{0,30}}))"
_NOT_SALARY = r"(?is)(?:[£$€]\s?[\d.,]+k?\s?(?:-|–|to)\s?)?[£$€]\s?[\d.,]+\s?(?:m\b|million|billion)|\b(?:budget|turnover|revenue)s?\W+(?:\w+\W+){0,3}?[£$€]\s?\d[\d,.']*k?(?:\s?(?:-|–|to|and)\s?[£$€]\s?\d[\d,.']*k?)?|(?:overtime|bonus)[^\w£$€]+(?:\w+[^\w£$€]+){0,2}?[£$€]\s?\d[\d,.']*k?"
_PERIODS = (
    ("hour", r"(?i)^\W{0,3}(?:per|an|/|p[./]?)\s?h(?:ou)?r?\b|^\W{0,3}ph\b"),
    ("day", r"(?i)^\W{0,3}(?:per|a|/|p[./]?)\s?d(?:ay)?\b|^\W{0,3}pd\b"),
    ("week", r"(?i)^\W{0,3}(?:per|a|/)\s?week\b|^\W{0,3}pw\b"),
    ("month", r"(?i)^\W{0,3}(?:per|a|/)\s?month\b|^\W{0,3}pcm\b"),
    ("year", r"(?i)^\W{0,3}(?:per|a|/)\s?(?:year|annum)\b|^\W{0,3}p[./]?a\b(?!\.?\s?y)"),
)


def salary(text: Column) -> Column:
    """struct<min, max, period> of the first acceptable salary of a text, yearly ones first; null when there is none.

    A k on the larger side counts for both; a range may be at most threefold; amounts above 10 000 without a period are
    yearly, amounts over a million are none."""
    clean = F.regexp_replace(text, _NOT_SALARY, " ")
    group = lambda k: F.regexp_extract_all(clean, F.lit(SALARY), F.lit(k))
    found = F.arrays_zip(*[group(k).alias(n) for k, n in ((1, "a"), (2, "ad"), (3, "ak"), (4, "b"), (5, "bd"), (6, "bk"), (7, "after"))])

    def amount(whole: Column, part: Column) -> Column:
        return F.concat(F.regexp_replace(whole, "[,.'’]", ""), part).try_cast("double")

    # each step's structs are built before the next reads them; in one expression every use would work out the amounts anew
    period = lambda after: F.coalesce(*[F.when(after.rlike(p), F.lit(name)) for name, p in _PERIODS])
    read = F.transform(found, lambda x: F.struct(
        amount(x["a"], x["ad"]).alias("low"), F.when(x["b"] != "", amount(x["b"], x["bd"])).alias("high"),
        (x["ak"] != "").alias("lk"), (x["bk"] != "").alias("hk"), period(x["after"]).alias("period")))
    # 400450 a day is a range that lost its dash
    lost = lambda x: x["high"].isNull() & ~x["lk"] & (x["period"] == "day") & x["low"].between(100_000, 999_999) & (x["low"] % 1000 >= F.floor(x["low"] / 1000)) & (x["low"] % 1000 <= 3 * F.floor(x["low"] / 1000))
    read = F.transform(read, lambda x: F.struct(
        F.when(lost(x), F.floor(x["low"] / 1000).cast("double")).otherwise(x["low"]).alias("low"), F.when(lost(x), x["low"] % 1000).otherwise(x["high"]).alias("high"),
        x["lk"].alias("lk"), x["hk"].alias("hk"), x["period"].alias("period")))
    scale = lambda v, own, any_k: F.when((own | (any_k & (v < 1000))) & (v < 10_000), v * 1000).otherwise(v)
    scaled = F.transform(read, lambda x: F.struct(scale(x["low"], x["lk"], x["lk"] | x["hk"]).alias("low"), scale(x["high"], x["hk"], x["lk"] | x["hk"]).alias("high"), x["period"].alias("period")))
    # "31,200 and 20 days" is no range
    ranged = F.transform(scaled, lambda x: F.struct(x["low"].alias("low"), F.when(x["high"] >= x["low"], x["high"]).otherwise(x["low"]).alias("top"), x["period"].alias("period")))
    full = F.transform(ranged, lambda x: F.struct(
        F.when((x["low"] * 1000 <= x["top"]) & (x["low"] < 1000), x["low"] * 1000).otherwise(x["low"]).alias("min"), x["top"].alias("max"),
        F.coalesce(x["period"], F.when(x["top"] > 10_000, F.lit("year"))).alias("period")))
    good = F.filter(full, lambda x: x["period"].isNotNull() & (x["min"] > 0) & (x["min"] <= x["max"]) & (x["max"] <= 3 * x["min"]) & (x["max"] <= 1_000_000))
    yearly_first = F.concat(F.filter(good, lambda x: x["period"] == "year"), good)
    return F.when(text.rlike("[£$€]"), F.get(yearly_first, F.lit(0)))


def phrase_hits(words: DataFrame, phrases: DataFrame, margin: float = 1.5, fraction: float = 0.75) -> DataFrame:
    """doc_id, phrase: phrases of whose different words at least this fraction stands within margin times their number of words
    of a text.

    words(doc_id, pos, word), phrases(phrase, word). A phrase of n words of which m have to stand together is looked up by its
    n - m + 1 rarest words only, as one of these has to be there; the other words are read where that is so. A word at a
    place counts for the windows that begin after its last place before, and at most a window's length back: it opens one
    more different word there and closes it behind its place, and a running sum over these turns is the number of different
    words of each window. Nothing is gathered, so a text may hold a phrase's words as often as it likes."""
    catalogue = phrases.select("phrase", "word").distinct()
    sizes = catalogue.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).withColumn("need", F.greatest(F.ceil(F.lit(fraction) * F.col("n") - 1e-9), F.lit(1)))
    # of the texts, only words of some phrase
    held = written(words.select("doc_id", "pos", "word").join(catalogue.select("word").distinct(), "word", "left_semi"))
    often = held.groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    sized = catalogue.join(sizes, "phrase").join(often, "word", "left")
    rare = sized.withColumn("place", F.row_number().over(W.partitionBy("phrase").orderBy(F.coalesce("often", F.lit(0)), "word"))).filter(F.col("place") <= F.col("n") - F.col("need") + 1)
    at = held.select("doc_id", "word").distinct().join(rare.select("word", "phrase"), "word").select("doc_id", "phrase").distinct()
    hits = held.join(at.join(sized.select("phrase", "word", "n", "need"), "phrase"), ["doc_id", "word"])

    before = F.lag("pos").over(W.partitionBy("doc_id", "phrase", "word").orderBy("pos"))
    # a window that begins at p holds q if q < p + margin n
    begin = F.greatest(before + 1, F.floor(F.col("pos") - F.lit(margin) * F.col("n")) + 1)
    turns = hits.withColumn("begin", begin).select("doc_id", "phrase", "need", F.inline(F.array(F.struct(F.col("begin").alias("at"), F.lit(1).alias("by")), F.struct((F.col("pos") + 1).cast("long").alias("at"), F.lit(-1).alias("by")))))
    turns = turns.groupBy("doc_id", "phrase", "need", "at").agg(F.sum("by").alias("by"))
    counts = turns.withColumn("k", F.sum("by").over(W.partitionBy("doc_id", "phrase").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)))
    return counts.filter("k >= need").select("doc_id", "phrase").distinct()


def written(df: DataFrame) -> DataFrame:
    """df, computed once into a folder that driver and executors share."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))
    path = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ratio(a: Column, b: Column) -> Column:
    """Similarity of 0 to 100: the edit distance against the longer text."""
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return 100.0 * (1 - F.levenshtein(a, b) / longest)


def alike(a: Column, b: Column, least: float) -> Column:
    """Whether `ratio` is above a bound, without working out distances that are beyond it."""
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    distance = F.call_function("levenshtein", a, b, F.ceil(longest * (1 - least / 100)).cast("int"))
    return _let(distance, lambda d: (d >= 0) & (100.0 * (1 - d / longest) > least))


def sorted_words(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(text), " "), lambda w: w != "")), " ")


#: In a block whose texts share grams this many times as often as it has pairs, all pairs are compared.
DENSE = 1.0
#: How many texts of a block meet how many others in one unit of work.
TILE = 1000


def near_pairs(df: DataFrame, block: str, id_col: str, title: str, text: str, title_least: float = 40, text_least: float = 75, length_most: float = 2.0, dense: float = DENSE) -> DataFrame:
    """a, b: pairs of one block with similar titles and texts, compared with their words sorted. Rows with equal words are
    one node, so copies are not paired with each other. Only pairs that `prefix_pairs` finds are compared, but all pairs of a
    block whose texts are so alike that this would make more rows than the block has pairs (see `tiled_pairs`)."""
    nodes = df.select(F.col(block).alias("k"), sorted_words(F.col(title)).alias("t"), sorted_words(F.col(text)).alias("x"), F.col(id_col).alias("id"))
    nodes = written(nodes.dropna(subset=["k", "t", "x"]).groupBy("k", "t", "x").agg(F.min("id").alias("id")))
    prefix = written(prefixes(nodes, text_least))
    shared = prefix.groupBy("k", "gram", "again").agg(F.count(F.lit(1)).alias("c")).groupBy("k").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("shared"))
    blocks = nodes.groupBy("k").agg(F.count(F.lit(1)).alias("size")).join(shared, "k")
    crowded = written(blocks.filter(F.col("shared") > F.lit(dense) * F.col("size") * (F.col("size") - 1)).select("k", "size"))

    both = met_pairs(prefix.join(crowded, "k", "left_anti"), text_least, length_most)
    for side in ("a", "b"):
        both = both.join(nodes.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("t", "x")]), side)
    kept = both.filter(alike(F.col("a_t"), F.col("b_t"), title_least)).filter(alike(F.col("a_x"), F.col("b_x"), text_least))
    least = {"x": text_least} if title == text and title_least <= text_least else {"x": text_least, "t": title_least}
    return kept.select("a", "b").unionByName(tiled_pairs(nodes.join(crowded, "k"), least, length_most))


def tiled_pairs(nodes: DataFrame, least: dict[str, float], length_most: float = 2.0, tile: int = TILE) -> DataFrame:
    """a, b: all pairs of nodes (id, k, size of k, texts) of one k whose texts have a `ratio` above their bound in `least`; the
    first text's lengths are within `length_most`.

    The nodes of a block are dealt to parts of about `tile`, and each two parts (or a part and itself) are one unit, which
    holds one part and streams the other. Pairs that are not alike are never rows, and the units of a large block
    are spread over all shuffle partitions. What all texts of a block begin with changes no distance, so it is cut off first."""
    ends = nodes.groupBy("k").agg(*[f(c).alias(f"{name}_{c}") for c in least for name, f in (("low", F.min), ("high", F.max))])
    begins = ends.select("k", *[common_beginning(F.col(f"low_{c}"), F.col(f"high_{c}")).alias(f"begin_{c}") for c in least])
    nodes = nodes.join(begins, "k")
    parts = F.ceil(F.col("size") / tile).cast("int")
    dealt = nodes.withColumns({"parts": parts, "part": F.pmod(F.xxhash64("id"), parts).cast("int")})
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(name: str, i: Column, j: Column) -> DataFrame:
        texts = [x for c in least for x in (F.substr(c, F.col(f"begin_{c}") + 1).alias(f"{name}_{c}"), F.length(c).alias(f"{name}_n{c}"))]
        other = F.explode(F.sequence("part", F.col("parts") - 1) if name == "a" else F.sequence(F.lit(0), "part")).alias("other")
        units = dealt.select("k", F.col("id").alias(name), *texts, "part", other)
        return units.withColumns({"i": i, "j": j}).drop("part", "other").repartition(count, "k", "i", "j")

    a, b = side("a", F.col("part"), F.col("other")), side("b", F.col("other"), F.col("part"))
    first = next(iter(least))
    longest, shortest = F.greatest(f"a_n{first}", f"b_n{first}"), F.least(f"a_n{first}", f"b_n{first}")
    met = a.join(b, ["k", "i", "j"]).filter((F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))).filter(longest <= length_most * shortest)
    for c, bound in least.items():
        edits = most_edits(F.greatest(f"a_n{c}", f"b_n{c}", F.lit(1)), bound)
        met = met.filter(F.call_function("levenshtein", F.col(f"a_{c}"), F.col(f"b_{c}"), edits) >= 0)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def common_beginning(a: Column, b: Column) -> Column:
    """The number of characters with which both texts begin; of the least and the greatest text it is that of all between."""
    characters = lambda x: F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))
    other = F.array_position(F.zip_with(characters(a), characters(b), lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(other > 0, other - 1).otherwise(F.length(a)).cast("int")


def most_edits(longest: Column, least: float) -> Column:
    """The most edits with which texts of which the longer one has so many characters have a `ratio` above a bound."""
    edits = F.ceil(longest * (1 - least / 100)).cast("int")
    above = lambda d: 100.0 * (1 - d / longest) > least
    return F.when(above(edits), edits).when(above(edits - 1), edits - 1).otherwise(edits - 2)


def prefix_pairs(nodes: DataFrame, least: float, length_most: float = 2.0, more: int = 4) -> DataFrame:
    """a, b: all pairs of nodes (id, k, x) of one k whose texts x may have a `ratio` above `least`; none above it is missing.

    A text of n characters has n + 1 grams of q characters (q is 2, or 1 for bounds up to 50; the ends are marked), and an edit
    changes at most q of them. Texts whose distance is within the bound's d therefore share n + 1 - q d grams of the longer
    one's. The grams of a text (the second one of a kind is a gram of its own) are put in order of rarity in their block, and
    only the first q d + 1 + `more` of each text are joined. What two texts share there, with what is left behind the last
    shared gram in either, and behind the end of either's part, has to reach the bound. The longer of two texts may allow more
    edits than the shorter one's own length does; q more grams of each make up for that."""
    return met_pairs(prefixes(nodes, least, more), least, length_most)


def prefixes(nodes: DataFrame, least: float, more: int = 4) -> DataFrame:
    """The grams of each text (k, gram, again, id, place) by which `prefix_pairs` looks for others, n, d and size of the text."""
    q = 2 if least > 50 else 1
    padded = F.concat(F.lit("\u0001"), "x", F.lit("\u0002"))
    n = F.length("x")
    grams = F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.substr(padded, i, F.lit(q)))
    edits = (F.ceil(n * (1 - least / 100) + 1e-9) - 1).cast("int")
    each = nodes.select("id", "k", n.alias("n"), edits.alias("d"), F.posexplode(grams).alias("pos", "gram"))
    each = each.withColumn("again", F.row_number().over(W.partitionBy("id", "gram").orderBy("pos")))
    often = each.groupBy("k", "gram", "again").agg(F.count(F.lit(1)).alias("often"))
    placed = each.join(often, ["k", "gram", "again"]).withColumn("place", F.row_number().over(W.partitionBy("id").orderBy("often", "gram", "again")))
    return placed.withColumn("size", F.least(F.col("n") + 1, F.col("d") * q + q + 1 + more)).filter("place <= size").select("k", "gram", "again", "id", "n", "d", "place", "size")


def met_pairs(prefix: DataFrame, least: float, length_most: float = 2.0) -> DataFrame:
    """a, b: the pairs of `prefix_pairs`, from its `prefixes`."""
    q = 2 if least > 50 else 1
    a, b = (prefix.select("k", "gram", "again", *[F.col(c).alias(f"{side}_{c}") for c in ("id", "n", "d", "place", "size")]) for side in "ab")
    longest, shortest = F.greatest("a_n", "b_n"), F.least("a_n", "b_n")
    lengths = (longest <= length_most * shortest) & (shortest >= F.lit(least / 100) * longest)
    met = a.join(b, ["k", "gram", "again"]).filter(F.col("a_id") < F.col("b_id")).filter(lengths)
    rest = lambda place: F.least(*[F.col(f"{side}_n") + 1 - place(side) for side in "ab"])
    behind = F.greatest(F.col("a_n") + 1 - F.col("a_size"), F.col("b_n") + 1 - F.col("b_size"))
    bound = longest + 1 - q * F.greatest("a_d", "b_d")
    of_pair = [F.min(x).alias(name) for x, name in ((behind, "behind"), (bound, "bound"), (F.col("a_n"), "a_n"), (F.col("b_n"), "b_n"))]
    pairs = met.groupBy(F.col("a_id").alias("a"), F.col("b_id").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.max("a_place").alias("a_last"), F.max("b_place").alias("b_last"), *of_pair)
    return pairs.filter(F.col("shared") + F.least("behind", rest(lambda side: F.col(f"{side}_last"))) >= F.col("bound")).select("a", "b")


def clusters(vectors: DataFrame, k: int, power: float = 0.0, half: bool = False) -> DataFrame:
    """label, cluster: agglomerative merging of the closest pair of groups until k are left; vectors(label, item, w).

    A group's vector is the sum of its members' (half: half the sum of the two that are merged), its name the first label. The
    distance is the angle, rounded to nine digits, times the lesser of both squared norms to `power`; of equal distances the
    first labels count. Groups are never added up again: the inner products of all pairs are a table, and a merger adds
    the rows of its two groups. A round merges as many pairs as the rule would, one after the other, provably: pairs that are each
    other's nearest, in order, as long as no other pair comes before them, and no group that the earlier ones make is nearer to
    any other. Tables have a row for a pair or a label and stay in the shared folder; the driver sees counts only."""
    both = vectors.groupBy("label", "item").agg(F.sum("w").alias("w"))
    label = both.select("label").distinct()
    norms = written(both.groupBy("label").agg(F.sum(F.col("w") * F.col("w")).alias("norm")))
    other = both.select(F.col("label").alias("b"), "item", F.col("w").alias("v"))
    shared = both.withColumnRenamed("label", "a").join(other, "item").filter("a < b").groupBy("a", "b").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    # every pair has a distance, those without a common item too
    grid = label.select(F.col("label").alias("a")).join(label.select(F.col("label").alias("b")), F.col("a") < F.col("b"))
    dots = written(grid.join(shared, ["a", "b"], "left").select("a", "b", F.coalesce("dot", F.lit(0.0)).alias("dot")))
    members = written(label.select("label", F.col("label").alias("cluster")))
    left = members.count()
    while left > max(k, 1):
        merged = written(_round_of_mergers(dots, norms, left - max(k, 1), power, half))
        left -= merged.count()
        to = merged.select(F.col("b").alias("was"), F.col("a").alias("now"))
        moved = lambda df, c: df.join(to, F.col(c) == F.col("was"), "left").withColumn(c, F.coalesce("now", F.col(c))).drop("was", "now")
        scale = lambda df, c: df.join(merged.select(F.col("a").alias("_a"), F.lit(0.5 if half else 1.0).alias("_f")), F.col(c) == F.col("_a"), "left").withColumn("_f", F.coalesce("_f", F.lit(1.0)))
        inner = dots.join(merged.select("a", "b"), ["a", "b"], "left_semi").select(F.col("a").alias("label"), (2 * F.col("dot")).alias("norm"))
        norms = moved(norms, "label").unionByName(inner).groupBy("label").agg(F.sum("norm").alias("norm"))
        norms = written(scale(norms, "label").select("label", (F.col("norm") * F.col("_f") * F.col("_f")).alias("norm")))
        pairs = moved(moved(dots, "a"), "b").filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("dot").alias("dot"))
        for c in ("a", "b"):
            pairs = scale(pairs, c).withColumn("dot", F.col("dot") * F.col("_f")).drop("_a", "_f")
        dots, members = written(pairs.select("a", "b", "dot")), written(moved(members, "cluster"))
    return members


def _angle(dot: str, norm_a: str, norm_b: str, power: float) -> Column:
    cosine = F.coalesce(F.try_divide(F.col(dot), F.sqrt(F.col(norm_a) * F.col(norm_b))), F.lit(0.0))
    return F.round(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) * F.least(F.pow(norm_a, F.lit(power)), F.pow(norm_b, F.lit(power))), 9)


def _round_of_mergers(dots: DataFrame, norms: DataFrame, most: int, power: float, half: bool) -> DataFrame:
    """a, b: at least one and at most `most` pairs that merging one after the other would merge next."""
    norm = lambda c, out: norms.select(F.col("label").alias(c), F.col("norm").alias(out))
    pairs = dots.join(norm("a", "na"), "a").join(norm("b", "nb"), "b")
    keyed = pairs.select("a", "b", "dot", "na", "nb", F.struct(_angle("dot", "na", "nb", power).alias("d"), "a", "b").alias("key"))
    best = keyed.select(F.explode(F.array("a", "b")).alias("label"), "key").groupBy("label").agg(F.min("key").alias("key"))
    # each other's nearest
    mutual = best.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("key.a", "key.b", F.col("key.d").alias("d"), "key")
    inside = mutual.select(F.explode(F.array("a", "b")).alias("label"), F.col("a").alias("now"))
    outside = keyed.join(inside.select(F.col("label").alias("a")), "a", "left_anti").join(inside.select(F.col("label").alias("b")), "b", "left_anti").agg(F.min("key").alias("first_other"))

    # how near each new group would be to the old ones, and to the other new ones
    by = 0.5 if half else 1.0
    new = mutual.join(keyed.select("a", "b", "dot", "na", "nb"), ["a", "b"]).select(F.col("a").alias("now"), ((F.col("na") + F.col("nb") + 2 * F.col("dot")) * by * by).alias("new_norm"))
    sides = dots.select("a", "b", "dot").unionByName(dots.select(F.col("b").alias("a"), F.col("a").alias("b"), "dot"))
    halves = sides.join(inside, F.col("a") == F.col("label")).select("now", F.col("b").alias("other"), (F.col("dot") * by).alias("dot"))
    belongs = inside.select(F.col("label").alias("other"), F.col("now").alias("other_now"))
    halves = halves.join(belongs, "other", "left").filter("other_now IS NULL OR other_now <> now")
    old = halves.groupBy("now", "other").agg(F.sum("dot").alias("dot")).join(norm("other", "other_norm"), "other")
    fresh = halves.filter("other_now IS NOT NULL").groupBy("now", F.col("other_now").alias("other")).agg(F.sum(F.col("dot") * by).alias("dot")).join(new.select(F.col("now").alias("other"), F.col("new_norm").alias("other_norm")), "other")
    near = old.select("now", "dot", "other_norm").unionByName(fresh.select("now", "dot", "other_norm")).join(new, "now")
    near = near.groupBy(F.col("now").alias("a")).agg(F.min(_angle("dot", "new_norm", "other_norm", power)).alias("near"))

    # one row for a pair of labels that are each other's nearest: a part of the catalogue
    order = W.orderBy("key")
    ranked = mutual.join(near, "a", "left").crossJoin(outside).withColumns({"place": F.row_number().over(order), "made": F.min("near").over(order.rowsBetween(W.unboundedPreceding, -1))})
    late = (F.col("key") > F.col("first_other")) | (F.col("made") <= F.col("d"))
    stopped = F.max(F.coalesce(late, F.lit(False)).cast("int")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return ranked.withColumn("stopped", stopped).filter((F.col("place") == 1) | (F.col("stopped") == 0)).filter(F.col("place") <= most).select("a", "b")


def reinforcement(declared: DataFrame, own: DataFrame, experiences: DataFrame, profile: str = "profile_id", skill: str = "phrase") -> DataFrame:
    """Each profile's declared skills with their scores: 1 where the profile's own text names the skill, which reinforces it,
    and 1 for each experience that does. Skills that no text names score 0; found skills that are not declared do not count."""
    hits = own.select(profile, skill, F.lit(True).alias("own")).distinct().unionByName(experiences.select(profile, skill, F.lit(False).alias("own")))
    scores = hits.groupBy(profile, skill).agg(F.count(F.lit(1)).alias("score"), F.bool_or("own").alias("reenforced"))
    out = declared.select(profile, skill).distinct().join(scores, [profile, skill], "left")
    return out.select(profile, skill, F.coalesce("score", F.lit(0)).cast("long").alias("score"), F.coalesce("reenforced", F.lit(False)).alias("reenforced"))


def overwrite_salaries(jobs: DataFrame, text: str, chosen: Column) -> DataFrame:
    """jobs whose salary columns are those found in the text, null where nothing is found; rows that are not chosen keep theirs."""
    found = salary(F.col(text))
    new = {"salary_min": found["min"], "salary_max": found["max"], "salary_period": found["period"]}
    return jobs.withColumns({c: F.when(chosen, v).otherwise(F.col(c)) for c, v in new.items()})


def crosswalk(companies: DataFrame, names: DataFrame, key: str, name: str, stop: list[str]) -> DataFrame:
    """key, matched, count: for each company the catalogue's name (matched, count) with an equal canonical form, taken with
    and without full stops, or else one that holds the company's form as whole words, or that it holds; at the least edit
    distance, the more frequent of equal ones. Null when there is none.

    A form can only be inside another that has its rarest word, so forms are joined by that word alone."""
    options = {"nospace": "'’", "brackets": True, "stop": [*stop, "limited", "ltd", "uk"]}
    forms = F.array_distinct(F.array(clean(F.col(name), **options), clean(F.replace(F.col(name), F.lit("."), F.lit("")), **options)))
    wanted = companies.select(key, name, F.explode(F.array_compact(forms)).alias("form"))
    known = names.withColumn("known_form", clean(F.col("matched"), **options)).filter("known_form IS NOT NULL")
    word = lambda c: F.explode(F.array_distinct(F.split(c, " "))).alias("word")
    known_words, wanted_words = known.select("matched", "count", "known_form", word("known_form")), wanted.select(key, name, "form", word("form"))
    often = known_words.groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    rarest = F.min_by("word", F.struct("often", "word")).alias("word")
    known_rare = known_words.join(often, "word").groupBy("matched", "count", "known_form").agg(rarest)
    # a word that no name of the catalogue has can't be in one
    wanted_rare = wanted_words.join(often, "word").groupBy(key, name, "form").agg(rarest, F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.size(F.array_distinct(F.split("form", " ")))).drop("n")
    holds = lambda outer, inner: F.contains(F.concat(F.lit(" "), outer, F.lit(" ")), F.concat(F.lit(" "), inner, F.lit(" ")))
    columns = [key, name, "form", "matched", "count", "known_form"]
    inside = wanted_words.join(known_rare, "word").filter(holds(F.col("form"), F.col("known_form"))).select(*columns)
    around = wanted_rare.join(known_words, "word").filter(holds(F.col("known_form"), F.col("form"))).select(*columns)
    order = F.struct(F.col("form") != F.col("known_form"), F.levenshtein(F.lower(name), F.lower("matched")), -F.col("count"), "matched")
    best = inside.unionByName(around).groupBy(key).agg(F.min_by(F.struct("matched", "count"), order).alias("best"))
    return companies.select(key).join(best, key, "left").select(key, "best.matched", "best.count")
