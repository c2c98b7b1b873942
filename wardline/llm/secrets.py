"""Secret scans: a random forest clears candidates of false positives.

Candidates are long runs of key characters. Their length, character transitions, dictionary
coverage, path and neighbouring words are columns made by SQL functions alone; a forest trained
on labelled findings tells secrets from other identifiers. No step leaves the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.scratch import written

#: Words of the corpus that count as a dictionary, by falling number of documents.
DICTIONARY_WORDS = 2_000
#: Labelled findings that training reads at most, by rising hash.
MAX_TRAINING = 20_000
TREES, DEPTH = 20, 6
_LEFT, _RIGHT = 40, 24
#: A run of at least 16 key characters with a digit and a letter.
RUN = r"(?<![A-Za-z0-9+/_.\-])(?=[A-Za-z+/_.\-]*+[0-9])(?=[0-9+/_.\-]*+[A-Za-z])[A-Za-z0-9+/_.\-]{16,}+"
#: Words before a value that name it a secret, or name it something else.
SECRET_WORDS = r"(?i)(api[_-]?key|access[_-]?key|auth|bearer|credential|passw|private[_-]?key|\bpwd\b|secret|token)"
PLAIN_WORDS = r"(?i)(checksum|commit|digest|etag|hash|href|http|md5|revision|sha1|sha256|src|uuid|version|@)"
FEATURES = (
    "length", "digit_share", "upper_share", "distinct_share", "transitions", "dictionary_share", "hex_only", "longest_letters",
    "slashes", "dots", "assigned", "quoted", "secret_word", "plain_word", "in_code_path",
)

_PLACE = ("id", "path", "nth", "value")

#: A name of a secret with its sign of assignment and quote. Names end where the sign stands.
_NAMED = r"(?i:api[_-]?key|access[_-]?key|auth|credentials?|passw(?:or)?d|passphrase|private[_-]?key|pwd|secret|token)[A-Za-z0-9_\-]{0,20}[\"'`]?[ \t]{0,3}(?::=|=>|=|:)[ \t]{0,3}"
#: Values by their place, of any length and characters: quoted or bare after such a name, or the password of an address.
PLACED = (
    # the short look back spares the long ones
    r"(?<=[=:>][ \t]{0,3}[\"'`]?)(?:"
    rf'(?<={_NAMED}")[^"\r\n]++(?=")|(?<={_NAMED}\')[^\'\r\n]++(?=\')|(?<={_NAMED}`)[^`\r\n]++(?=`)'
    rf"|(?<={_NAMED})[^\s\"'`=>][^\s\"'`]*+|(?<=[a-z]://[^\s/:@]{{0,30}}:)[^\s/]+(?=@))"
)
FOUND = f"{PLACED}|{RUN}"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, path, nth, left, value, right): each run of key characters and each value in a secret's place.

    ``left`` and ``right`` are the 40 and 24 characters beside it, up to the next run. ``nth``
    counts a row's runs from 0, so repeats of a value in a text are findings of their own. Null
    and empty texts have none; a null path counts as empty. No other column is read.
    """
    body = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    rows = docs.where(body.rlike(FOUND)).select(
        docs[f"`{id_col}`"].alias("id"),
        F.coalesce(docs[f"`{path_col}`"].cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(body, F.lit(FOUND), F.lit(0)).alias("found"),
        F.transform(F.split(body, FOUND, -1), lambda g: F.struct(F.right(g, F.lit(_LEFT)).alias("end"), F.left(g, F.lit(_RIGHT)).alias("start"))).alias("gaps"),
    )
    one = F.transform(
        "found",
        lambda v, i: F.struct(
            i.cast("long").alias("nth"), F.get("gaps", i)["end"].alias("left"), v.alias("value"), F.get("gaps", i + 1)["start"].alias("right")
        ),
    )
    return rows.select("id", "path", F.explode(one).alias("c")).select("id", "path", "c.*")


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The words of at least four letters that most texts of the corpus hold."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(docs[f"`{text_col}`"], F.lit(""))), F.lit(r"\b[a-z]{4,12}\b"), F.lit(0)))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(words).collect()]


def _share(part: Column, whole: Column) -> Column:
    return F.length(part) / whole


def _without(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def features(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with a number for each of FEATURES."""
    v, n = F.col("value"), F.length("value")
    # one letter per class; what is left after runs of a class shrink to one is the class changes
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), r"[+/_.\-]+", "-")
    letters = F.regexp_extract_all(F.lower(v), F.lit("[a-z]{4,}"), F.lit(0))
    covered = F.aggregate(F.array_intersect(letters, F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")), F.lit(0), lambda a, w: a + F.length(w))
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit("[A-Za-z]+"), F.lit(0)), F.length)), F.lit(0))
    near = F.substring_index("left", "\n", -1)
    in_address = near.rlike(r"[a-z]://[^\s/:@]{0,30}:$")
    made = {
        "length": n,
        "digit_share": _share(_without(v, "0-9"), n),
        "upper_share": _share(_without(v, "A-Z"), n),
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
        "transitions": (F.length(classes) - 1) / n,
        "dictionary_share": covered / n,
        "hex_only": v.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "longest_letters": longest,
        "slashes": F.length(_without(v, "/")),
        "dots": F.length(_without(v, ".")),
        "assigned": near.rlike(r"[=:>]\s*[\"'`]?$"),
        "quoted": near.rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]"),
        "secret_word": near.rlike(SECRET_WORDS) | in_address,
        "plain_word": (near.rlike(PLAIN_WORDS) | F.col("right").rlike("^@")) & ~in_address,
        "in_code_path": F.col("path").rlike(r"(?i)(\.(py|js|java|go|env|ya?ml|json|cfg|ini|sh)$|/(config|secrets?)/)"),
    }
    return found.withColumns({k: F.coalesce(made[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def findings_by_rule(found: DataFrame) -> DataFrame:
    """Labelled findings from the two rules that are nearly sure, where no others are given.

    A value assigned to a secret's name is one; a value with dots, in an address or beside a word
    for something else is none. All others stay without a label and are for the forest to judge.
    """
    secret = (F.col("secret_word") == 1) & (F.col("assigned") == 1) & (F.col("dots") == 0)
    plain = (F.col("plain_word") == 1) | ((F.col("dots") > 0) & (F.col("secret_word") == 0))
    return found.withColumn("label", F.when(secret, 1.0).when(plain, 0.0)).where(F.col("label").isNotNull())


def classify(found: DataFrame, labelled: DataFrame, max_rows: int = MAX_TRAINING) -> DataFrame:
    """``found`` with probability and is_secret (at least one half), by a forest over FEATURES.

    ``labelled`` holds FEATURES and a label of 0 or 1; rows with a null label are left out. The
    forest reads ``max_rows`` of them, half of each label at most. With one label only, that
    label is the answer; with none, every probability is 0.5 and all candidates stay findings.
    """
    # by place and value, so that findings of equal features are not drawn together
    key = F.xxhash64(*[c for c in _PLACE if c in labelled.columns], *FEATURES).alias("_key")
    known = labelled.where(F.col("label").isNotNull()).select("label", *FEATURES, key)
    sides = [known.where(F.col("label") == x).orderBy("_key", *FEATURES).limit(max_rows // 2) for x in (0.0, 1.0)]
    sample = sides[0].unionByName(sides[1]).drop("_key")
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        probability = F.lit(next(iter(counts)) if counts else 0.5)
        return found.withColumn("probability", probability).withColumn("is_secret", F.col("probability") >= 0.5)
    weights = F.when(F.col("label") == 1, sum(counts.values()) / counts[1.0]).otherwise(sum(counts.values()) / counts[0.0])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector")
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", weightCol="_weight", rawPredictionCol="_raw", probabilityCol="_probability",
        predictionCol="_prediction", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="sqrt", subsamplingRate=0.8, seed=7,
    )
    model = forest.fit(vectors.transform(sample.withColumn("_weight", weights)))
    judged = model.transform(vectors.transform(found))
    return (
        judged.withColumn("probability", vector_to_array("_probability")[1])
        .withColumn("is_secret", F.col("probability") >= 0.5)
        .drop("_vector", "_raw", "_probability", "_prediction")
    )


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of all texts, judged. ``labelled`` findings default to those of the rules.

    Null and empty texts have no candidates, and an empty table gives an empty result. Repeated
    rows and repeated ids give their findings each; equal findings in equal places get equal
    probabilities, and one half counts as a secret. A null path is an empty one, a null id stays.
    Columns other than the id, the text and the path are not read, so no name can clash.
    """
    # read by each round of the forest, so it is written once
    found = written(features(candidates(docs), dictionary(docs)), "candidates")
    return classify(found, findings_by_rule(found) if labelled is None else labelled)
