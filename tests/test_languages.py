"""Language by trigram profiles: against brute force, on held-out documents, and with countries."""

from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from skillweave.operators import languages as g


def grams(text):
    s = " " + regex.sub(r"[^\p{L}]+", " ", text.lower()).strip(" ") + " "
    return [s[i : i + 3] for i in range(len(s) - 2)]


def brute(train, texts, size, least):
    counts = defaultdict(Counter)
    for text, lang in train:
        counts[lang].update(grams(text))
    ranks = {k: {w: i for i, (w, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size])} for k, c in counts.items()}
    told = []
    for text in texts:
        all_of = grams(text or "")
        near = sorted((sum(r.get(w, size) for w in all_of), k) for k, r in ranks.items())
        name = near[0][1]
        hits = sum(w in ranks[name] for w in all_of)
        told.append(name if text and hits and hits * 100 >= least * len(all_of) else None)
    return told


TRAIN = [("The cat and the dog of the house", "en"), ("Der Hund und die Katze", "de"), ("le chat et la souris", "fr"), ("kot i pies", "pl"), (None, "en"), ("nobody knows", None)]
TEXTS = ["the house", "Die Katze!", "la souris", "zzz qqq", "...", "", None, "the the the " * 5000, "und the und", "Ⅻ 漢字 \U0001d400", "Straße Ünder"]


@pytest.mark.parametrize("size, least", [(400, 30), (5, 0), (12, 50)])
def test_nearest_profile_as_by_hand(spark, size, least):
    train = spark.createDataFrame(TRAIN, "text string, lang string")
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    known = g.profiles(train, size=size)
    assert max(Counter(x.lang for x in known.collect()).values()) <= size
    found = {x.id: x.language for x in g.detected(rows, ["id"], "text", known, size, least).collect()}
    wanted = brute([x for x in TRAIN if x[0] and x[1] in g.LANGUAGES], TEXTS, size, least)
    assert [found[k] for k in range(len(TEXTS))] == wanted
    assert found[7] == "en" and found[3] is None and found[6] is None


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    known = g.profiles(docs.filter(~F.col("held")))
    told = g.assigned(docs.filter("held"), ["doc_id", "lang"], "text", known, None, "en").collect()
    assert len(told) == docs.filter("held").count()
    assert sum(x.lang == x.language for x in told) >= 0.95 * len(told)


def test_country_when_the_text_tells_nothing(spark):
    known = g.profiles(spark.createDataFrame(TRAIN, "text string, lang string"))
    rows = [(1, "the cat and the dog", "Germany"), (2, "zzz", "GERMANY "), (3, None, "Россия"), (4, "zzz", "Atlantis"), (5, None, None), (None, "der Hund", None), (None, "und die Katze", None)]
    df = spark.createDataFrame(rows, "id int, text string, country string")
    told = lambda default: {x.id: x.language for x in g.assigned(df, ["id", "country"], "text", known, "country", default).collect()}
    assert told(None) == {1: "en", 2: "de", 3: "ru", None: "de"}
    assert told("en") == {1: "en", 2: "de", 3: "ru", 4: "en", 5: "en", None: "de"}
    empty = spark.createDataFrame([], df.schema)
    assert g.assigned(empty, ["id", "country"], "text", known, "country", "en").count() == 0
    assert g.assigned(df, ["id"], "text", known.limit(0)).count() == 0
