"""Secret scans: rules find candidates, a random forest removes false positives.

Candidates are tokens of known provider formats, values assigned to a credential
name, and long tokens of mixed characters. The forest sees a candidate's length,
its transitions between character classes, its share of digits, capitals and hex
digits, how much of it dictionary words cover, whether its path looks like a
test or an example, and its neighbouring words on both sides, hashed. It is
trained on labelled findings: those given, or by default findings that rules can
label surely; half of these secrets are learnt without the name they stand by.

Plan at scale: one pass over the text makes candidates with their features and
is written once; everything later works on candidates only. The dictionary is
every word of at least MIN_DOCS documents, counted with early reduction and kept
as a table that is joined to the candidates' runs of letters. The forest is
fitted on at most MAX_FINDINGS labelled values of each label, the first by a
hash of the value, so that one value which a third of all findings share counts
once; the labels weigh the same, however rare one is. All of it is built-in
functions and Spark's own forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import query, table
from fieldstar.llm.spans import matches, overlapped
from fieldstar.session import stage, staging_path

MIN_DOCS = 5
# Of each label.
MAX_FINDINGS = 20_000
TREES = 20
DEPTH = 6
ACCEPT = 0.5
# Changes between letters and digits per character from which a bare token may be random.
MIXED = 0.1
SEED = 7

TOKEN = r"[A-Za-z0-9+/_=.~-]"
CREDENTIAL = (
    r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|bearer|private[_-]?key"
    r"|credentials?)"
)
# What may follow the credential word in a name: SECRET_ACCESS_KEY, token-prod. Parts before it need no pattern.
NAME_PARTS = r"(?:[_.-]{1,2}[A-Za-z0-9]{1,64}+){0,8}+"
# An assigned value has this many characters at least; inside quotes it reaches to the closing one.
LEAST_VALUE = 6
ASSIGN = r"[\x20\t]*+[:=][\x20\t]*+"
VALUE = (
    rf"(?:\"[^\"\n]{{{LEAST_VALUE},}}+\"|'[^'\n]{{{LEAST_VALUE},}}+'|[\"']?+[^\x20\x09-\x0D\"']{{{LEAST_VALUE},}}+)"
)
# Each rule's matches are single words or assignments of any length. Every quantifier is possessive or bounded, and a
# token is tried from its first character only, so the time is linear in the text.
RULES = {
    "provider": r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+"
    r"|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_-])",
    "assigned": rf"(?i)(?<![A-Za-z0-9]){CREDENTIAL}{NAME_PARTS}[\"']?{ASSIGN}{VALUE}",
    "generic": rf"(?<!{TOKEN})(?=[A-Za-z+/_=.~-]*+[0-9])(?=[0-9+/_=.~-]*+[A-Za-z]){TOKEN}{{16,}}+",
}
NEEDS = {"provider": r"AKIA|gh[oprsu]_|xox|sk_live_|AIza", "assigned": r"[:=]", "generic": r"[0-9]"}
PLACEHOLDER = r"(?i)(example|changeme|placeholder|dummy|sample|redacted|your[_-]|xxxx|1234567|abcdef|(.)\1{5})"
# Hashed buckets of the word before a candidate, and of the one after it.
BUCKETS = 8
NEIGHBOURS = [f"{side}{k}" for side in ("word_before_", "word_after_") for k in range(BUCKETS)]
FEATURES = [
    "length", "transitions", "digits", "capitals", "hex", "distinct", "coverage", "test_path", "named", "before_short", "words_before",
    *NEIGHBOURS,
]


def _candidates(df: DataFrame, id_col: str, text_col: str, path: Column) -> DataFrame:
    """One row per candidate: _row, _id, rule, start, end, value, before, path."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = [matches(text, RULES[rule], NEEDS[rule]).alias(rule) for rule in RULES]
    wide = df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), path.alias("_path"), *found
    )
    kinds = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("all")) for r in RULES])
    long = wide.select("_row", "_id", "_path", F.explode(kinds).alias("k"))
    long = long.select("_row", "_id", "_path", "k.rule", F.explode("k.all").alias("x"))
    # An assignment's value is what follows the sign, without the quotes around it.
    raw = F.when(F.col("rule") == "assigned", F.regexp_extract("x.v", rf"(?s)^[^:=]*+[:=][\x20\t]*+(.*)$", 1)).otherwise(
        F.col("x.v")
    )
    opens = F.col("_raw").rlike("^[\"']") & (F.col("rule") == "assigned")
    closes = opens & (F.length("_raw") > 1) & (F.left("_raw", F.lit(1)) == F.right("_raw", F.lit(1)))
    head, tail = F.when(opens, 1).otherwise(0), F.when(closes, 1).otherwise(0)
    value = F.substring("_raw", head + 1, F.length("_raw") - head - tail)
    trimmed = F.when(F.col("_closed"), F.col("_value")).otherwise(F.rtrim("_value", F.lit(".,;:!?)]}")))
    start = F.col("x.e") - F.length("_raw") + F.col("_head")
    known = long.withColumn("_raw", raw).withColumns({"_value": value, "_head": head, "_closed": closes})
    return known.select(
        "_row", "_id", "_path", "rule", start.alias("start"), (start + F.length(trimmed)).alias("end"), trimmed.alias("value"),
        F.concat(F.col("x.c"), F.substring(F.col("x.v"), F.lit(1), F.length("x.v") - F.length("_raw") + F.col("_head"))).alias("before"),
        F.col("x.a").alias("after"),
    )


def _one_per_place(found: DataFrame) -> DataFrame:
    """Of candidates of one document that overlap, the surest rule's: provider, assigned, generic."""
    is_ = lambda rule: F.col("rule") == rule
    seen = found.withColumns({
        "_by_provider": overlapped(is_("provider"), "_row", "start", "end"),
        "_by_assigned": overlapped(is_("assigned"), "_row", "start", "end"),
    })
    beaten = (~is_("provider") & F.col("_by_provider")) | (is_("generic") & F.col("_by_assigned"))
    # An assignment that only a provider's format has beaten does not beat in its turn: its own place is the provider's.
    return seen.filter(~beaten).drop("_by_provider", "_by_assigned")


def common_words(df: DataFrame, text_col: str, least: int) -> DataFrame:
    """The lower-case words of 3 to 12 letters that at least `least` documents have: column word."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"\p{L}++"), F.lit(0))
    words = F.array_distinct(F.filter(words, lambda w: F.length(w).between(3, 12)))
    counted = df.select(F.explode(words).alias("word")).groupBy("word").count()
    return counted.filter(F.col("count") >= least).select("word")


def _covered(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates with `covered`, the letters of their values that are dictionary words."""
    key = ["_row", "start", "rule"]
    runs = F.split(F.regexp_replace("value", r"([a-z])(?=[A-Z])", "$1 "), r"[^A-Za-z]+", -1)
    parts = found.select(*key, F.explode(runs).alias("_run")).filter(F.length("_run").between(3, 12))
    met = parts.join(dictionary, F.lower("_run") == F.col("word"))
    sums = met.groupBy(*key).agg(F.sum(F.length("_run")).alias("covered"))
    return found.join(sums, key, "left").withColumn("covered", F.coalesce("covered", F.lit(0)))


def _features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    value, size = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    same = F.regexp_count(shape, F.lit(r"([aB0])(?=\1)"))
    last = F.regexp_extract("before", r"([^\x20\x09-\x0D]++)[\x20\x09-\x0D\"']*$", 1)
    next_ = F.regexp_extract("after", r"^[\x20\x09-\x0D\"']*([^\x20\x09-\x0D]++)", 1)
    word = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}]", "")
    bucket = lambda c: F.when(word(c) != "", F.crc32(word(c).cast("binary")) % BUCKETS)
    of = {"word_before_": bucket(last), "word_after_": bucket(next_)}
    neighbours = {
        f"{side}{k}": F.coalesce(of[side] == k, F.lit(False)).cast("double") for side in of for k in range(BUCKETS)
    }
    return _covered(found, dictionary).withColumns({
        "length": size,
        "transitions": (size - 1 - same) / size,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "hex": share("[0-9a-fA-F]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "coverage": F.col("covered") / size,
        "test_path": F.coalesce("_path", F.lit("")).rlike(r"(?i)test|example|sample|fixture|docs?/").cast("double"),
        "named": F.col("before").rlike(rf"(?i){CREDENTIAL}{NAME_PARTS}[\"']?[\x20\t]*[:=]?[\x20\t]*[\"']?$").cast("double"),
        "before_short": (F.length(last) <= 3).cast("double"),
        "words_before": F.size(F.split(F.trim("before"), r"[\x20\x09-\x0D]+")).cast("double"),
        **neighbours,
    }).drop("covered")


def surely_labelled(found: DataFrame) -> DataFrame:
    """Findings that rules can label: 1 for a secret, 0 for a false positive; the rest are left out.

    Among those left out are bare tokens whose digits stand among letters all along, as in a random key.
    """
    fake = F.col("value").rlike(PLACEHOLDER) | (F.col("coverage") >= 0.5)
    random = (F.col("distinct") * F.col("length") >= 8) & (F.col("digits") > 0) & (F.col("digits") < 1)
    mixed = F.regexp_count("value", F.lit(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")) / F.col("length") >= MIXED
    plain = ~mixed & ((F.col("digits") < 0.15) | (F.col("hex") < 0.4))
    label = (
        F.when(fake, 0)
        .when((F.col("rule") != "generic") & random, 1)
        .when((F.col("rule") == "generic") & (F.col("named") == 0) & plain, 0)
    )
    return found.withColumn("label", label.cast("double")).filter("label is not null")


def scan_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    labelled=surely_labelled,
    max_findings: int = MAX_FINDINGS,
    accept: float = ACCEPT,
) -> DataFrame:
    """One row per candidate: id, start, end, rule, value_sha256, score, is_secret.

    Places are code points, end exclusive; the value itself is not returned.
    `labelled` maps the featurised findings to those with a label column, 0 or
    1; up to `max_findings` distinct values of each label are learnt from. NULL
    and empty texts have no candidates; rows that repeat an id are scanned each.
    Without findings of both labels no forest can be fitted: then a provider's
    format or an assignment scores 1 unless it looks like a placeholder, and
    anything else 0. An empty table gives no row. Other columns are ignored.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    dictionary = common_words(df, text_col, MIN_DOCS)
    found = stage(_candidates(df, id_col, text_col, path), "secret-candidates")
    found = stage(_features(_one_per_place(found), dictionary), "secret-features")
    known = labelled(found).groupBy("value", "label").agg(*[F.max(c).alias(c) for c in FEATURES])
    known = stage(known, "secret-labelled")
    first = lambda label: known.filter(F.col("label") == label).orderBy(F.xxhash64("value"), "value").limit(max_findings)
    known = stage(first(0).unionByName(first(1)), "secret-labels")
    # Half of the secrets are learnt without their names, or the forest would only learn the rules again.
    hidden = (F.col("label") == 1) & (F.crc32(F.col("value").cast("binary")) % 2 == 0)
    known = known.withColumn("named", F.when(hidden, 0.0).otherwise(F.col("named")))
    out = [
        F.col("_id").alias(id_col), "start", "end", "rule", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        "score", (F.col("score") >= accept).alias("is_secret"),
    ]
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        plain = (F.col("rule") != "generic") & ~F.col("value").rlike(PLACEHOLDER)
        return found.withColumn("score", plain.cast("double")).select(*out)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label", weightCol="weight", cacheNodeIds=False
    )
    half = sum(sizes.values()) / 2
    weight = F.when(F.col("label") == 1, half / sizes[1.0]).otherwise(half / sizes[0.0])
    path = staging_path(df.sparkSession, "secret-forest")
    forest.fit(assembler.transform(known.withColumn("weight", weight))).write().save(path)
    # Read back, the model has no training summary, which would drag the session into its tasks.
    model = RandomForestClassificationModel.load(path)
    scored = model.transform(assembler.transform(found))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*out)


@query("op7_secret_scan")
def op7_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
