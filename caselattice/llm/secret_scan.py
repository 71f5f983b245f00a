"""Secret scans with a random forest that removes false positives. DataFrame and SQL functions only.

Candidates are of three kinds: runs of 16 or more key characters with a digit or mixed case; values of ``least`` (4) or
more characters that a word such as ``password`` is set to, whatever their characters; and the bodies of armoured blocks.
Secrets that are none of these, such as a short password in plain prose, are not looked for. A random forest judges
each candidate by its length, its transitions between character classes, how much of it a dictionary of the corpus's own
words covers, its path and its neighbouring words. The forest is trained from labelled findings: a table of the
caller's, or one made from rules (`labelled_findings`), since findings labelled by hand are rare; such labels are weak.
`train` takes a bounded sample of them, and `held_out` tells precision and recall on those that it never sees.

Null texts have no candidate; a null path is an empty one. A candidate that is there twice gives two rows; repeated rows
are judged alike. Whole texts are read, without a shuffle of texts. Extra columns are not read. An empty table of
findings cannot train a forest and is refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_SPACES = " \t\n\x0b\f\r"
#: A run of key characters inside a word.
CANDIDATE = r"[A-Za-z0-9_+/=\-]{16,}"
_LOOKS_RANDOM = r"[0-9]|[a-z][A-Z]|[A-Z]{4}"
#: Words that tell of a secret or of a harmless value nearby, and parts of paths.
SECRET_WORDS = "password passwd pwd secret token apikey api key auth bearer credential credentials private access login pass".split()
HARMLESS_WORDS = "commit sha sha1 sha256 md5 checksum digest uuid guid hash version revision etag build example sample test placeholder dummy certificate public".split()
TEST_PATHS = "test tests spec example examples sample doc docs fixture fixtures mock".split()
CONFIG_PATHS = "config conf env settings deploy secrets credentials properties yml yaml ini".split()

FEATURES = [
    "length", "digit_share", "upper_share", "lower_share", "symbol_share", "run_share", "longest_repeat", "entropy", "is_hex", "vowel_share",
    "coverage", "secret_word", "harmless_word", "assigned", "quoted", "test_path", "config_path", "before_length", "after_length",
]


def dictionary(docs: DataFrame, *, text: str = "text", words: int = 20_000, piece: int = 3) -> DataFrame:
    """(piece) of the letters in the corpus's ``words`` most frequent words of 3 to 12 letters, counted over all texts.

    A dictionary is of frequent words: with all words, parts of the secrets themselves would be in it.
    """
    found = F.explode(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w).between(3, 12)))
    counted = docs.select(found.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequent = counted.orderBy(F.desc("n"), "word").limit(words)
    return frequent.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - (piece - 1)), lambda i: F.substring("word", i, piece))).alias("piece")).distinct()


def candidates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", least: int = 4) -> DataFrame:
    """(doc_id, position, candidate, before, key, after, word, path): candidates with the words around them.

    position: the word's index in its text, from 0; key: what stands before the candidate in its own word, or the head of
    an armoured block.
    """
    words = F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_SPACES)), common.SPACE_CLASS)
    held = docs.select(F.col(doc_id).alias("doc_id"), (F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")).alias("path"), words.alias("words"))
    near = lambda i, k: F.coalesce(F.get("words", i + k), F.lit(""))
    set_here = lambda w: F.contains(w, F.lit("=")) | F.contains(w, F.lit(":"))
    block = lambda w, i: F.when(w == "-----BEGIN", F.slice("words", i + 2, F.size("words")))
    met = F.transform(
        "words",
        lambda w, i: F.when(
            F.rlike(w, F.lit(CANDIDATE)) | set_here(w) | F.endswith(near(i, -1), F.lit("=")) | F.endswith(near(i, -1), F.lit(":")) | (w == "-----BEGIN"),
            F.struct(i.cast("long").alias("position"), w.alias("word"), F.concat_ws(" ", near(i, -2), near(i, -1)).alias("before"), near(i, 1).alias("after"), block(w, i).alias("rest")),
        ),
    )
    # few words are looked at closer; their expressions are compiled by themselves, beside no text
    rows = common.stash(held.select("doc_id", "path", F.explode(F.array_compact(met)).alias("c")).select("doc_id", "path", "c.*"), "secret-words")
    kinds = rows.withColumns(
        {
            "runs": F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), F.lit(1)),
            # name=value inside a word, or a word after "name =", "name:" and the like, without quotes and final marks
            "inline": F.regexp_extract("word", rf"(?i)(?:^|[^a-z0-9])(?:{'|'.join(SECRET_WORDS)})[\"']?[:=]{{1,2}}[\"'(]?([^\s\"'=][^\s\"']*)", 1),
            "told": F.when(F.rlike("before", F.lit(rf"(?i)(?:^|[^a-z0-9])(?:{'|'.join(SECRET_WORDS)})[\"']?\s?[:=]{{1,2}}$")), F.regexp_extract("word", r"^[\"'(\[]*([^\s\"'=][^\s\"']*)", 1)).otherwise(F.lit("")),
            "head": F.when(F.col("rest").isNotNull(), F.slice("rest", 1, F.array_position(F.transform("rest", lambda w: F.endswith(w, F.lit("-----"))), True).cast("int"))),
            "ends": F.array_position("rest", "-----END").cast("int"),
        }
    )
    body = F.array_join(F.slice("rest", F.size("head") + 1, F.greatest(F.col("ends") - F.size("head") - 1, F.lit(0))), "")
    bare = lambda c: F.regexp_replace(c, r"[,.;:)\]]+$", "")
    made = lambda value, kind: F.struct(value.alias("value"), F.lit(kind).alias("kind"))
    each = F.concat(
        F.transform("runs", lambda v: made(v, "run")),
        F.filter(F.array(made(bare(F.col("inline")), "set"), made(bare(F.col("told")), "set"), made(F.coalesce(F.when(F.col("ends") > 0, body), F.lit("")), "block")), lambda v: F.length(v["value"]) >= least),
    )
    rows = kinds.withColumn("v", F.explode(each)).select("doc_id", "path", "position", "word", "before", "after", "head", "v.value", "v.kind", "inline", "told")
    # name=value inside one run of key characters: the part after the last sign that is followed by a long value
    name = F.when(F.col("kind") == "run", F.regexp_extract("value", r"^([A-Za-z][A-Za-z0-9_\-]*)=(?=[A-Za-z0-9_+/\-]{12,})", 1)).otherwise(F.lit(""))
    rows = rows.withColumn("name", name)
    rows = rows.withColumn("candidate", F.when(F.col("name") != "", F.substr("value", F.length("name") + 2, F.length("value"))).otherwise(F.col("value")))
    lead = F.when(F.col("kind") == "set", F.expr("substring_index(word, value, 1)")).otherwise(F.regexp_extract("word", r"^([^A-Za-z0-9]*[A-Za-z_\-]*[=:\"'(\[]+)", 1))
    rows = rows.withColumn("key", F.when(F.col("kind") == "block", F.concat(F.array_join("head", " "), F.lit(":"))).when(F.col("name") != "", F.concat("name", F.lit("="))).otherwise(lead))
    random = F.rlike("candidate", F.lit(_LOOKS_RANDOM)) & (F.length("candidate") >= 12)
    # a run that is the value set, or a part of it, is that candidate
    found = rows.where((F.col("kind") != "run") | random & ~F.contains(F.col("inline"), F.col("candidate")) & ~F.contains(F.col("told"), F.col("candidate")))
    return found.select("doc_id", "position", "candidate", "before", "key", "after", "word", "path")


def _has_word(text: Column, words: list[str]) -> Column:
    return F.rlike(F.lower(text), F.lit(r"(^|[^a-z0-9])(" + "|".join(words) + r")($|[^a-z0-9])")).cast("double")


def features(found: DataFrame, pieces: DataFrame, *, piece: int = 3) -> DataFrame:
    """Adds FEATURES to candidates. The dictionary is joined to their letter pieces and summed per distinct candidate."""
    value, n = F.col("candidate"), F.length("candidate").cast("double")
    share = lambda pattern: 1 - F.length(F.regexp_replace(value, pattern, "")) / n
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]", "-"), "[a-z]", "l"), "[A-Z]", "U"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    chars = F.split(value, "")
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - F.size(F.filter(chars, lambda x: x == c)) / n * F.log2(F.size(F.filter(chars, lambda x: x == c)) / n))
    around = F.concat_ws(" ", "before", "key")
    one = found.select("candidate").distinct()
    letters = F.explode(F.transform(F.sequence(F.lit(1), F.length("candidate") - (piece - 1)), lambda i: F.lower(F.substring("candidate", i, piece))))
    covered = one.select("candidate", letters.alias("piece")).join(pieces.withColumn("known", F.lit(1)), "piece", "left")
    covered = covered.groupBy("candidate").agg((F.count("known") / F.count(F.lit(1))).alias("coverage"))
    shaped = found.withColumns(
        {
            "length": n,
            "digit_share": share("[0-9]"),
            "upper_share": share("[A-Z]"),
            "lower_share": share("[a-z]"),
            "symbol_share": share("[^A-Za-z0-9]"),
            "run_share": runs / n,
            "longest_repeat": (F.rlike(value, F.lit(r"(.)\1\1\1")).cast("double") + F.rlike(value, F.lit(r"(.)\1{7}")).cast("double")),
            "entropy": entropy,
            "is_hex": F.rlike(value, F.lit("^[0-9a-fA-F-]+$")).cast("double"),
            "vowel_share": share("[aeiouAEIOU]"),
            "secret_word": _has_word(around, SECRET_WORDS),
            "harmless_word": F.greatest(_has_word(around, HARMLESS_WORDS), _has_word(value, HARMLESS_WORDS)),
            "assigned": F.rlike(around, F.lit(r"[=:]['\"]?$")).cast("double"),
            "quoted": F.rlike("word", F.lit(r"['\"]")).cast("double"),
            "test_path": _has_word(F.col("path"), TEST_PATHS),
            "config_path": _has_word(F.col("path"), CONFIG_PATHS),
            "before_length": F.least(F.length("before"), F.lit(40)).cast("double"),
            "after_length": F.least(F.length("after"), F.lit(40)).cast("double"),
        }
    )
    return shaped.join(covered, "candidate", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def labelled_findings(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """Findings with labels, made from rules: (candidate, before, key, after, word, path, label, kind).

    True ones are digests cut and spelled as issued keys are (hex, base 64, upper case with digits), after words that
    name secrets or bare, made-up passwords that such a word is set to, and bodies of private-key blocks; false ones are
    digests that are named as such, identifiers made of words, words in capitals, numbers, placeholders and dates, plain words and
    variables that a secret's name is set to, and bodies of certificates. ``rows`` bounds the table.
    """
    i = F.col("id")
    pick = lambda options, salt: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(options))) + 1).cast("int"))
    hexes = F.sha2(F.concat(F.lit("k"), i.cast("string")), 256)
    base = F.regexp_replace(F.base64(F.unhex(hexes)), "=+$", "")
    upper = F.upper(F.regexp_replace(base, "[^A-Za-z0-9]", "Q"))
    cut = (F.pmod(F.xxhash64(i, F.lit("cut")), F.lit(24)) + 16).cast("int")
    syllables = ["ing", "tion", "er", "con", "data", "file", "user", "item", "log", "man", "the", "re", "in", "es", "al", "view", "name", "list", "get", "set"]
    words = F.concat_ws("", *[pick(syllables, f"s{k}") for k in range(7)])
    short = F.concat_ws("", *[pick(syllables, f"u{k}") for k in range(2)])
    snake = F.concat_ws("_", *[pick(syllables, f"t{k}") for k in range(6)])
    digits = F.substring(F.concat(F.abs(F.xxhash64(i, F.lit("d"))).cast("string"), F.lit("4071")), 1, 16)
    secret_key = F.concat(pick(["password", "token", "secret", "api_key", "auth", "passwd", "access_key"], "w"), pick(["=", ":", '="', ": "], "a"))
    harmless = F.concat(pick(["commit", "sha256", "md5", "checksum", "uuid", "build", "etag", "revision"], "h"), pick([":", "=", " ", ": "], "b"))
    prose = F.concat_ws(" ", pick(syllables, "p0"), pick(syllables, "p1"))
    passwords = F.concat(F.initcap(short), F.substring(digits, 1, 3), pick(["!", "&", "#", "$", "", "?", "-"], "m"), F.substring(base, 3, 3))
    long_body = F.concat(F.base64(F.unhex(hexes)), F.base64(F.unhex(F.sha2(hexes, 256))), F.base64(F.unhex(F.sha2(hexes, 512))))
    # (label, candidate, before, key)
    told, bare = F.concat_ws(" ", prose, secret_key), prose
    mixed = F.when(F.pmod(i, F.lit(5)) < 2, bare).otherwise(told)
    inline = F.when((F.pmod(i, F.lit(7)) < 4) & (F.pmod(i, F.lit(5)) >= 2), secret_key).otherwise(F.lit(""))
    nothing = F.lit("")
    kinds = {
        "hex": (1, F.substring(hexes, 1, 40), mixed, inline),
        "hex_cut": (1, F.substr(hexes, F.lit(1), cut), mixed, inline),
        "upper": (1, F.substring(upper, 1, 20), mixed, inline),
        "base": (1, F.substr(base, F.lit(1), cut + 4), mixed, inline),
        "password": (1, passwords, told, inline),
        "short_hex": (1, F.substring(hexes, 1, 8), told, inline),
        "private_block": (1, long_body, prose, pick(["RSA PRIVATE KEY-----:", "PRIVATE KEY-----:", "EC PRIVATE KEY-----:", "OPENSSH PRIVATE KEY-----:"], "pk")),
        "named_digest": (0, F.substring(hexes, 1, 40), F.concat_ws(" ", prose, harmless), nothing),
        "snake": (0, F.concat(snake, F.lit("_"), F.pmod(i, F.lit(97)).cast("string")), prose, nothing),
        "joined_words": (0, F.concat(words, F.pmod(i, F.lit(89)).cast("string")), prose, nothing),
        "shouted_words": (0, F.upper(words), F.upper(prose), nothing),
        "filler": (0, F.concat(F.rpad(pick(["x", "0", "1234", "ab"], "r"), 20, "x"), F.lit("0")), prose, nothing),
        "date": (0, F.concat_ws("-", F.lit("2024"), F.lpad(F.pmod(i, F.lit(12)).cast("string"), 2, "0"), F.lpad(F.pmod(i, F.lit(28)).cast("string"), 2, "0"), F.lpad(i.cast("string"), 9, "0")), prose, nothing),
        "number": (0, digits, prose, nothing),
        "number_groups": (0, F.concat_ws("-", *[F.substring(digits, k, 4) for k in (1, 5, 9, 13)]), prose, nothing),
        "path_like": (0, F.concat_ws("/", F.initcap(words), snake, F.lit("v2")), prose, nothing),
        "set_to_word": (0, pick(["none", "null", "true", "false", "required", "string", "optional", "hidden", "value", "default", "changeme", "enabled"], "v"), told, inline),
        "set_to_words": (0, F.concat(short, pick(["", "s", "_id", "_name", "()"], "e")), told, inline),
        "set_to_variable": (0, F.concat(pick(["${", "$(", "<", "{{", "%("], "o"), F.upper(short), pick(["}", ")", ">", "}}", ")s"], "o")), told, inline),
        "certificate": (0, long_body, prose, pick(["CERTIFICATE-----:", "PUBLIC KEY-----:", "RSA PUBLIC KEY-----:"], "ck")),
    }
    around = (pick(syllables, "n").alias("after"), pick(["", "src", "config/app", "docs", "tests/unit", "env", "news"], "path").alias("path"))
    made = [
        spark.range(k, rows, len(kinds), 1).select(value.alias("candidate"), before.alias("before"), key.alias("key"), *around, F.lit(float(label)).alias("label"), F.lit(kind).alias("kind"))
        for k, (kind, (label, value, before, key)) in enumerate(kinds.items())
    ]
    return reduce(DataFrame.unionByName, made).withColumn("word", F.concat("key", "candidate"))


def _is_held(modulus: int) -> Column:
    return F.pmod(F.xxhash64("candidate", "before", "key"), F.lit(modulus)) == 0


def train(labelled: DataFrame, pieces: DataFrame, *, trees: int = 40, depth: int = 10, seed: int = 17, max_findings: int = 20_000, modulus: int = 5) -> RandomForestClassificationModel:
    """A random forest on labelled findings but for one in ``modulus``, by a hash of what is found, and on ``max_findings``
    of these at most, in the order of another hash; rows are sorted, so that equal tables give equal forests."""
    usable = labelled.where(~_is_held(modulus) & F.col("label").isNotNull()).orderBy(F.xxhash64("candidate", "before", "key", "word", "path"), "candidate", "before", "label").limit(max_findings)
    rows = features(usable, pieces).select(*FEATURES, "label").coalesce(1).sortWithinPartitions(*FEATURES, "label")
    rows = common.stash(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label"), "secret-labelled")
    if rows.isEmpty():
        raise ValueError("no labelled findings to train from")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows)


def judge(found: DataFrame, pieces: DataFrame, model: RandomForestClassificationModel, threshold: float) -> DataFrame:
    """Adds FEATURES, the forest's ``score`` and its verdict ``is_secret``."""
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(found, pieces)))
    score = F.round(F.get(vector_to_array("probability"), 1), 9)
    return scored.withColumn("score", score).withColumn("is_secret", F.col("score") >= threshold)


def held_out(labelled: DataFrame, pieces: DataFrame, *, threshold: float = 0.5, modulus: int = 5, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, n, n_true, n_flagged, precision, recall) on the findings that `train` leaves out."""
    judged = judge(labelled.where(_is_held(modulus)), pieces, train(labelled, pieces, modulus=modulus), threshold)
    both, flagged, true = F.count_if((F.col("label") == 1) & F.col("is_secret")), F.count_if("is_secret"), F.count_if(F.col("label") == 1)
    ratio = lambda a, b: F.when(b > 0, a / b)
    return judged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), true.alias("n_true"), flagged.alias("n_flagged"), ratio(both, flagged).alias("precision"), ratio(both, true).alias("recall"))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate of every whole text with the forest's ``score`` and verdict ``is_secret``."""
    spark = docs.sparkSession
    pieces = common.stash(dictionary(docs, text=text), "secret-dictionary")
    model = train(labelled if labelled is not None else labelled_findings(spark), pieces)
    found = common.stash(candidates(docs, doc_id=doc_id, text=text, path=path), "secret-candidates")
    judged = judge(found, pieces, model, threshold)
    return judged.select("doc_id", "position", "candidate", F.trim(F.concat_ws(" ", "before", "key")).alias("context"), *FEATURES, "score", "is_secret")
