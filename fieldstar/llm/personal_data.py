"""Personal data: fixed patterns as seeds, contextual patterns learnt from them.

Seeds are found by four regular expressions and checked (parts of an address,
digits of a number, Luhn sums). What stands before a seed is a lexical pattern:
the two words before it, or the one. Patterns and the instances (values) they
precede form a graph. In every round a pattern is as good as the instances it
meets, and an instance as good as the patterns that meet it. Instances that a
round trusts support patterns in the next one as seeds do, so that what is
learnt reaches contexts in which no seed stands; candidates whose patterns are
trusted in the last round become spans of the kind that the patterns call for. Candidates are words that look like identifiers and that no
seed covers.

Plan at scale: one pass over the text makes seeds and candidates with their
contexts and is written once; the rounds move only (pattern, instance) counts,
combined before they are shuffled, so that a context which a third of all rows
share is a few numbers per task. Only documents that hold a digit or an "@" run
the regular expressions. Every expression takes time in proportion to the text.
All of it is built-in functions; positions come from the pieces between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import bind, query, table
from fieldstar.llm.spans import matches, overlapped
from fieldstar.session import stage

KINDS = ("email", "ip", "card", "phone")
# The same matches as without the look-behind and the possessive quantifiers,
# which keep a long run of such characters from being scanned from each of its places.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
# A candidate: a word with a digit or "@" inside; the marks around it are trimmed off.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
MARKS = ".,;:!?()[]{}<>\"'"
ROUNDS = 3
TRUSTED = 0.6
# Seeds, or instances that the last round trusts, which a pattern must meet.
LEAST_SEEDS = 3
PRIOR = 1.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of 16 to 19 digits passes the Luhn sum."""
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def term(place):
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(place % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(places, F.lit(0), lambda sum_, place: sum_ + term(place))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of a kind's pattern is one of the kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # At most 255: leading zeros, then up to three digits below 256.
        small = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
        return F.concat(value, F.lit(".")).rlike(rf"^(?:{small}\.){{4}}$")
    size = F.length(_digits(value))
    if kind == "phone":
        return size.between(8, 15)
    return F.when(size.between(16, 19), bind(_digits(value), _luhn)).otherwise(False)


def _likely_kind(value: Column) -> Column:
    """The kind that a word outside all seeds could be, by its shape; NULL for most words."""
    digits = F.length(_digits(value))
    bare = ~value.rlike(r"[A-Za-z=\"]")
    return (
        F.when(value.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]"), "email")
        .when(bare & value.rlike(r"^[0-9]++(?:[.:][0-9]++){3,7}$"), "ip")
        .when(bare & (digits >= 12), "card")
        .when(bare & (digits >= 7), "phone")
    )


def _patterns(before: Column) -> Column:
    """Lexical patterns of a place: the last word before it, and the last two."""
    plain = F.regexp_replace(F.lower(before), "[0-9]+", "0")
    words = F.regexp_extract_all(plain, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    pick = lambda w: F.array_distinct(
        F.array(F.array_join(F.slice(w, -F.least(F.size(w), F.lit(1)), 1), " "),
                F.array_join(F.slice(w, -F.least(F.size(w), F.lit(2)), 2), " "))
    )
    return bind(words, lambda w: F.when(F.size(w) == 0, F.array(F.lit(""))).otherwise(pick(w)))


def _scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Seeds by kind and the words that look like identifiers, one row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def seeds_of(kind):
        return F.filter(matches(text, PATTERNS[kind], NEEDS[kind]), lambda x: _holds(kind, x["v"]))

    def trimmed(x):
        head = F.length(x["v"]) - F.length(F.ltrim(x["v"], F.lit(MARKS)))
        value = F.trim(x["v"], F.lit(MARKS))
        return F.struct(
            (x["s"] + head).alias("s"), (x["s"] + head + F.length(value)).alias("e"), value.alias("v"), x["c"].alias("c"),
            x["a"].alias("a"),
        )

    words = F.filter(
        F.transform(matches(text, CANDIDATE, "[0-9@]"), trimmed), lambda x: _likely_kind(x["v"]).isNotNull()
    )
    return df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        *[seeds_of(kind).alias(f"_{kind}") for kind in KINDS],
        words.alias("_words"),
    )


def _occurrences(scanned: DataFrame) -> DataFrame:
    """(_row, s, e, v, kind, seed, _pattern): every seed, and every candidate that no seed overlaps, by pattern.

    Places are rows of their own before they are compared, so that a text with
    many of them never carries them all along with each.
    """
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(True).alias("seed"), F.col(f"_{k}").alias("all")) for k in KINDS
    ])
    seeds = scanned.select("_row", F.explode(kinds).alias("k"))
    seeds = seeds.select("_row", "k.kind", "k.seed", F.inline("k.all"))
    words = scanned.select("_row", F.inline("_words"))
    words = words.select("_row", _likely_kind(F.col("v")).alias("kind"), F.lit(False).alias("seed"), "s", "e", "v", "c", "a")
    both = seeds.unionByName(words).withColumn("_clash", overlapped(F.col("seed")))
    free = both.filter(F.col("seed") | ~F.col("_clash"))
    return free.select("_row", "kind", "seed", "s", "e", "v", F.explode(_patterns(F.col("c"))).alias("_pattern"))


def find_personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    trusted: float = TRUSTED,
    least_seeds: int = LEAST_SEEDS,
) -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans.

    Counts and base_sha256 are of the fixed patterns; `spans` has these and the
    `n_added` ones found by context, as kind:start:end by kind, then start. A
    NULL or empty text has no spans. Rows that repeat an id are scanned each; a
    value counts once per pattern however often it is repeated. Spans do not
    overlap within a kind. An empty table gives no row. Other columns are
    ignored.
    """
    scanned = stage(_scan(df, id_col, text_col), "identifiers")
    seen = stage(_occurrences(scanned), "identifier-contexts")
    graph = seen.groupBy("_pattern", "kind", "v").agg(F.max("seed").alias("seed"))
    graph = stage(graph, "pattern-graph")
    sizes = stage(graph.groupBy("_pattern").agg(F.count("*").alias("_n")).withColumnRenamed("_pattern", "_p"), "patterns")

    belief = graph.withColumn("_belief", F.col("seed").cast("double"))
    scores = None
    for _ in range(rounds):
        # What an earlier round has made sure of induces patterns like a seed does.
        good = belief.groupBy("_pattern", "kind").agg(
            F.sum("_belief").alias("_sum"), F.count_if(F.col("_belief") >= trusted).alias("_sure")
        )
        good = good.filter(F.col("_sure") >= least_seeds)
        scores = good.join(sizes, F.col("_pattern") == F.col("_p")).select(
            F.col("_pattern").alias("_by"), F.col("kind").alias("_kind"),
            (F.col("_sum") / (F.col("_n") + PRIOR)).alias("_score"),
        )
        scores = stage(scores, "pattern-scores")
        met = graph.filter("not seed").join(
            scores, (F.col("_pattern") == F.col("_by")) & (F.col("kind") == F.col("_kind")), "left"
        )
        weight = F.coalesce("_score", F.lit(0.0))
        learnt = met.groupBy(F.col("v").alias("_v"), F.col("kind").alias("_k")).agg(F.max(weight).alias("_learnt"))
        learnt = stage(learnt, "instance-scores")
        belief = graph.join(learnt, (F.col("v") == F.col("_v")) & (F.col("kind") == F.col("_k")), "left").withColumn(
            "_belief", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("_learnt", F.lit(0.0)))
        )
    added = seen.filter("not seed").select("_row", "kind", "s", "e", "_pattern")
    if scores is None:
        added = added.limit(0)
    else:
        sure = scores.filter(F.col("_score") >= trusted)
        added = added.join(sure, (F.col("_pattern") == F.col("_by")) & (F.col("kind") == F.col("_kind")), "left_semi")
    added = added.select("_row", "kind", "s", "e").distinct()
    place = lambda kind: F.element_at(F.create_map(*[F.lit(x) for k in enumerate(KINDS) for x in k[::-1]]), kind)
    entry = F.struct(place(F.col("kind")).alias("o"), "s", "e", F.col("kind").alias("k"))
    added = added.groupBy(F.col("_row").alias("_at")).agg(F.collect_list(entry).alias("_added"))

    def entries(order, kind):
        return F.transform(
            F.col(f"_{kind}"),
            lambda x: F.struct(F.lit(order).alias("o"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k")),
        )

    base = F.concat(*[entries(order, kind) for order, kind in enumerate(KINDS)])
    text_of = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ","
    )
    more = F.coalesce(F.col("_added"), F.array().cast("array<struct<o:int,s:int,e:int,k:string>>"))
    joined = scanned.drop("_words").join(added, F.col("_row") == F.col("_at"), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.size(more).cast("long").alias("n_added"),
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"),
        text_of(F.array_sort(F.concat(base, more))).alias("spans"),
    )


@query("op5_personal_data")
def op5_personal_data(spark, sf_dir):
    return find_personal_data(table(spark, sf_dir, "documents"))
