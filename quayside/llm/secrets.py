"""Secret scan: candidates from patterns, false positives removed by a random forest.

A candidate is a value in a word, of at least ``MIN_LENGTH`` key characters with a digit among them, or of any kind if its name or the word before tells so. The forest sees its length and character
transitions, how much of it a dictionary of the corpus's commonest words covers, the path it was found under and its neighbouring words. It is trained
from labelled findings; without any, from the candidates whose format or context alone says what they are. Only built-in functions and
Spark's own forest are used; only candidates, not texts, leave the scan.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import BLANKS, lower_ascii, written

MIN_LENGTH = 12
#: Most labelled findings that the forest is trained on, chosen by a hash; forest size.
FINDINGS, TREES, DEPTH = 20_000, 24, 8
#: Words of the dictionary, the commonest of the corpus with three letters or more.
DICTIONARY = 400
#: Slots of the hashed path; two paths rarely share one.
PATH_SLOTS = 32
FLAGGED = 0.5
QUOTES = "\"'`()[]{}<>,;:!?"
#: Words that announce a secret, and words that announce something else.
KEY_WORDS = "passw|pwd|secret|token|api_?key|apikey|access_?key|auth|credential|private"
#: Names, or their ends, whose values are candidates whatever their length and alphabet, from ``SHORTEST`` characters on.
TELLING = r"(?:passwd|password|passphrase|pwd|secret|token|api_?key|access_?key|private_?key|secret_?key|credentials?)"
SHORTEST = 4
#: User and password of an address.
USER = r"(?<=[A-Za-z0-9+.\-])://([^:/?#@\"'`]*):([^/?#\"'`]+)@"
#: A telling name with what stands before it, or its last 64 characters, and a value that isn't in brackets. Written so that no character is looked at more than some 64 times, however long a word is.
NAMED = r"(?:(?<![A-Za-z0-9_.\-])[A-Za-z0-9_.\-]{0,64}|(?<=[A-Za-z0-9_.\-]{64}))(?i:" + TELLING + r")[\"'`]?(?:=>|[:=]+)(?![\"'`]?[$%]?[{(<\[])(?:\"[^\"]+|'[^']+|`[^`]+|[^\"'`&;,]+)"
USER_PARTS = r"^://([^:]*):(.+)@$"
NAME, SEPARATOR = r"^[A-Za-z0-9_.\-]+", r"^[A-Za-z0-9_.\-]+[\"'`]?(?:=>|[:=]+)[\"'`]?"
#: Longer values have no plain format but that of a number.
LONGEST_FORMAT = 200
#: Values that only refer to one.
NO_VALUE = r"^([$%]?[{(<\[].*|\$[A-Za-z_]+|(?i:null|none|true|false|undefined|string)|[*.x]+)$"
OTHER_WORDS = "sha|md5|commit|hash|uuid|guid|checksum|digest|version|phone|card|order|isbn|example|test|sample|dummy"
#: Formats that are secrets whatever stands around them, and formats that never are.
SECRET_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abpr]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35})$"
PLAIN_FORMATS = r"^([0-9]+|[0-9]+([.\-/][0-9]+)+|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|v?[0-9]+(\.[0-9]+)+[0-9A-Za-z.\-]*)$"

FEATURES = [
    "length", "distinct", "uppers", "lowers", "digits", "marks", "class_changes", "case_changes", "hex", "longest_letters",
    "covered", "key_before", "key_name", "other_before", "assigned", "quoted", "neighbours_known", *[f"path_{i}" for i in range(PATH_SLOTS)],
]


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``doc_id, position, value, name, quoted, before, before2, after, path``: a row for each candidate of ``docs``.

    ``position`` counts the text's words from 0; a word can hold several candidates, one for each value between separators ``= : & ; ,``,
    quotes, brackets, ``? @ #`` and ``://``; also the whole between quotes or white space if a telling name stands before it. ``name`` is what stands before
    the value's own ``=`` or ``:``; in an address with a user it is the user. A value is a candidate if it has
    ``MIN_LENGTH`` key characters with a digit, or any ``SHORTEST`` characters under a telling name or behind a telling word. Null and empty texts have none.
    """
    telling = rf"(?i){TELLING}"
    # Every candidate holds such a run, or stands under a telling name or in an address with a user, and few texts do.
    digit_run = rf"[A-Za-z0-9+/_.\-]{{{MIN_LENGTH // 2}}}[0-9]|[0-9][A-Za-z0-9+/_.\-]{{{MIN_LENGTH // 2}}}"
    likely = docs.where(F.col("text").rlike(digit_run) | F.col("text").rlike(rf"(?i){KEY_WORDS}") | F.col("text").rlike(USER))
    words = F.filter(F.split("text", f"{BLANKS}+"), lambda w: w != "")
    shifted = lambda w: [
        F.concat(F.array(F.lit("")), w).alias("before"), F.concat(F.array(F.lit(""), F.lit("")), w).alias("before2"), F.concat(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), F.array(F.lit(""))).alias("after")
    ]
    in_place = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("position")))
    around = F.arrays_zip(in_place.alias("at"), *shifted(words))
    announced = lambda z: z["before"].rlike(rf"{telling}[\"'`]?(=>|[:=]+)$") | (z["before"].rlike(r"^(=>|[:=]+)$") & z["before2"].rlike(rf"{telling}[\"'`]?$"))
    by_shape = lambda w: (F.length(w) >= MIN_LENGTH) & w.rlike("[0-9]")
    found = F.filter(around, lambda z: z["at"].isNotNull() & (by_shape(z["at"]["word"]) | z["at"]["word"].rlike(rf"{telling}[\"'`]?[=:]") | z["at"]["word"].rlike(USER) | announced(z)))
    rows = likely.select("doc_id", F.col(f"`{path}`").cast("string").alias("path"), F.explode(found).alias("z"))
    word = F.col("z.at.word")
    # Name and value, each value with the name just before it; then users' passwords and the rest of the word behind a telling name.
    pair = r"""(?:([^=:&;,"'`(){}<>\[\]?@#]++)["'`]?[=:]+["'`]?)?([^=:&;,"'`(){}<>\[\]?@#]++=*+)"""
    nothing = F.array().cast("array<struct<name:string,value:string,told:boolean>>")
    found_as = lambda name, value, told: F.struct(name.alias("name"), value.alias("value"), F.lit(told).alias("told"))
    has_name, has_user = word.rlike(rf"{telling}[\"'`]?[=:]"), F.contains(word, F.lit("://"))
    told = F.transform(F.regexp_extract_all(word, F.lit(NAMED), F.lit(0)), lambda m: found_as(F.regexp_extract(m, NAME, 0), F.regexp_replace(m, SEPARATOR, ""), True))
    user = F.transform(
        F.regexp_extract_all(word, F.lit(USER), F.lit(0)), lambda m: found_as(F.concat(F.regexp_extract(m, USER_PARTS, 1), F.lit(":password")), F.regexp_extract(m, USER_PARTS, 2), True)
    )
    told = F.array_distinct(F.concat(F.when(has_user, user).otherwise(nothing), F.when(has_name, told).otherwise(nothing)))
    alone = F.btrim(word, F.lit(QUOTES[:3] + ",;"))
    is_alone = announced(F.col("z")) & (F.length(alone) >= SHORTEST) & ~alone.rlike(NO_VALUE)
    # No part of a told value is a candidate beside it.
    rest = F.when(has_user, F.regexp_replace(word, USER, ",")).otherwise(word)
    rest = F.when(has_name, F.regexp_replace(rest, NAMED, ",")).otherwise(rest)
    names, values = (F.regexp_extract_all(rest, F.lit(pair), F.lit(i)) for i in (1, 2))
    in_word = F.transform(F.arrays_zip(names.alias("name"), values.alias("value")), lambda p: found_as(p["name"], p["value"], False))
    alone = F.when(is_alone, F.array(found_as(F.lit(""), alone, True))).otherwise(in_word)
    cleaned = F.transform(F.concat(told, alone), lambda c: F.struct(F.btrim(c["name"], F.lit(QUOTES)).alias("name"), F.btrim(c["value"], F.when(c["told"], F.lit(QUOTES[:3])).otherwise(F.lit(QUOTES + "."))).alias("value"), c["told"].alias("told")))
    context = [word.rlike("[\"'`]").alias("quoted"), *[lower_ascii(F.coalesce(F.col(f"z.{c}"), F.lit(""))).alias(c) for c in ("before", "before2", "after")]]
    rows = rows.select("doc_id", F.col("z.at.position").alias("position"), *context, "path", cleaned.alias("cleaned"))
    key = rf"^[A-Za-z0-9+/_.\-]{{{MIN_LENGTH},}}=*$"
    fits = lambda c: F.when(c["told"], (F.length(c["value"]) >= SHORTEST) & ~c["value"].rlike(NO_VALUE)).otherwise(c["value"].rlike(key) & c["value"].rlike("[0-9]"))
    rows = rows.withColumn("c", F.explode(F.filter("cleaned", fits)))
    return rows.select("doc_id", "position", F.col("c.value").alias("value"), lower_ascii(F.col("c.name")).alias("name"), "quoted", "before", "before2", "after", "path")


def dictionary(docs: DataFrame, words: int = DICTIONARY) -> list[str]:
    """The commonest words of all texts with three letters or more."""
    counted = docs.select(F.explode(F.split(lower_ascii(F.col("text")), r"[^a-z\x{80}-\x{10FFFF}]+")).alias("word")).where(F.length("word") >= 3).groupBy("word").count()
    return [r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(words).collect()]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def features(found: DataFrame, known: list[str]) -> DataFrame:
    """Adds ``FEATURES`` to candidates; ``known`` is the dictionary."""
    value, changes = F.col("value"), F.greatest(F.length("value") - 1, F.lit(1))
    runs = F.regexp_extract_all(lower_ascii(value), F.lit("[a-z]{3,}"), F.lit(0))
    listed = F.array(*[F.lit(w) for w in known]).cast("array<string>")
    is_known = lambda w: F.array_contains(listed, F.btrim(w, F.lit(QUOTES + "."))).cast("int")
    covered = F.aggregate(F.filter(runs, lambda r: F.array_contains(listed, r)), F.lit(0), lambda n, r: n + F.length(r))
    before = F.concat_ws(" ", "before2", "before", "name")
    computed = {
        "length": F.length(value).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "uppers": _share(value, "[A-Z]"),
        "lowers": _share(value, "[a-z]"),
        "digits": _share(value, "[0-9]"),
        "marks": _share(value, r"[+/_.=\-]"),
        "class_changes": F.regexp_count(value, F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")) / changes,
        "case_changes": F.regexp_count(value, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / changes,
        "hex": value.rlike("^[0-9a-f]+$").cast("double"),
        "longest_letters": F.array_max(F.transform(F.concat(F.array(F.lit("")), runs), F.length)).cast("double"),
        "covered": covered / F.length(value),
        "key_before": F.concat_ws(" ", "before2", "before").rlike(KEY_WORDS).cast("double"),
        "key_name": F.col("name").rlike(KEY_WORDS).cast("double"),
        "other_before": before.rlike(OTHER_WORDS).cast("double"),
        "assigned": (F.col("before").isin("=", ":", ":=", "=>") | (F.col("name") != "")).cast("double"),
        "quoted": F.col("quoted").cast("double"),
        "neighbours_known": (is_known(F.col("before")) + is_known(F.col("before2")) + is_known(F.col("after"))).cast("double"),
    }
    slot = F.pmod(F.xxhash64(F.coalesce("path", F.lit(""))), F.lit(PATH_SLOTS))
    computed |= {f"path_{i}": (slot == i).cast("double") for i in range(PATH_SLOTS)}
    return found.withColumns({name: computed[name] for name in FEATURES})


def _is_plain(value: Column) -> Column:
    return F.when(F.length(value) <= LONGEST_FORMAT, value.rlike(PLAIN_FORMATS)).otherwise(value.rlike("^[0-9]++$"))


def own_label() -> Column:
    """1 for a candidate that format or context makes a secret without doubt, 0 for one that they make none, else null."""
    around = F.concat_ws(" ", "before2", "before", "name")
    assigned = F.col("name").rlike(KEY_WORDS) | F.col("before").isin("=", ":", ":=", "=>")
    secret = F.col("value").rlike(SECRET_FORMATS) | (around.rlike(KEY_WORDS) & ~_is_plain(F.col("value")) & assigned)
    return F.when(secret, 1.0).when(_is_plain(F.col("value")) | around.rlike(OTHER_WORDS), 0.0)


def own_labels(found: DataFrame) -> DataFrame:
    """Candidates with a ``label`` where format or context leaves no doubt; the others are left out."""
    return found.withColumn("label", own_label()).where(F.col("label").isNotNull())


def train(labelled: DataFrame, seed: int = 9) -> RandomForestClassificationModel | None:
    """A forest from rows with ``FEATURES`` and ``label``; None unless both labels occur.

    Equal rows are one with their number as weight, so a value that is everywhere doesn't push out the others; of each label ``FINDINGS / 2`` are taken, by a hash.
    The sample is sorted into one partition, so reruns agree.
    """
    distinct = written(labelled.groupBy(*FEATURES, "label").agg(F.count("*").cast("double").alias("weight")), "labelled-findings")
    of_label = lambda label: distinct.where(F.col("label") == label).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(FINDINGS // 2)
    sample = written(of_label(0.0).unionByName(of_label(1.0)).coalesce(1), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.coalesce(1).sortWithinPartitions(*FEATURES, "label"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt", weightCol="weight").fit(ready)


def scan(docs: DataFrame, findings: DataFrame | None = None, path: str = "source", flagged: float = FLAGGED) -> DataFrame:
    """``doc_id, position, value, score, is_secret`` for each candidate of ``docs`` (doc_id, text and the path column).

    ``findings`` are labelled candidates: rows as ``candidates`` gives them and a ``label`` of 1 (secret) or 0; null labels are none. Without both labels there is nothing to learn from: the score is what
    format or context alone says, 0 if that is nothing. Each row of ``docs`` is a document; a null path is a path of its own.
    """
    known = dictionary(docs)
    found = written(features(candidates(docs, path), known), "candidates")
    labelled = own_labels(found) if findings is None else features(findings.where(F.col("label").isNotNull()), known)
    forest = train(labelled.withColumn("label", F.col("label").cast("double")))
    if forest is None:
        scored = found.withColumn("score", F.coalesce(own_label(), F.lit(0.0)))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features_").transform(found)
        scored = forest.setFeaturesCol("features_").transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "position", "value", F.round("score", 6).alias("score"), (F.round("score", 6) >= flagged).alias("is_secret"))
