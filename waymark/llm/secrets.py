"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more characters of keys and tokens, or any 6 or more
characters without a space that follow a secret's name and = or :. Its features are its
length, changes of character class, shares of digits, vowels and punctuation, share covered
by dictionary words, signs of a path or address around it, and the words next to it. The forest learns from
labelled findings, kept as rules that state what is and what is not a secret, from
which Spark makes ``FINDINGS`` examples. Confirmed secrets are replaced in the text.

Null and empty texts have no candidates and stay as they are. Rows that share a doc_id
are scanned one by one, and repeated rows alike. An empty table gives an empty one; a text of
any length is scanned whole; other columns can have any name. Only DataFrame functions and spark.ml's
forest, which runs in the JVM, are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_table, row_key, with_results

MASK = "<SECRET>"
BEFORE, AFTER = 40, 20
FINDINGS = 3000
TREES, TREE_DEPTH = 24, 7

# Fixed words. A dictionary of what names and placeholders are made of, words that stand
# next to secrets, and words that stand next to other long values.
DICTIONARY = """about access account admin alpha app article asset base beta blog build cache client code
    com config content copy css data date default demo dev doc document download example false file final
    font foo form free group home html http image img index info input item java key lang latest lib link
    list local log main map master media menu min model module name new news note null num object order
    page part password path photo picture post prod product public read release report sample script
    section server service session set site size static style system table tag temp test text theme time
    title token true type update upload url user value version video view web word xml your""".split()
SECRET_WORDS = """password passwd passwort pwd token secret apikey api_key api-key accesskey access_key
    access-key auth authorization bearer credential credentials privatekey private_key client_secret
    aws_secret key""".split()
PLAIN_WORDS = """commit sha sha1 sha256 md5 checksum digest hash uuid guid id version build card iban phone
    tel isbn order invoice serial page http https www href src img etag revision integrity""".split()
FEATURES = """size changes coverage digits uppers vowels marks distinct hex base32 dashes path address named
    plain assigned quoted issued""".split()

# After a secret's name and = or :, what is in quotes, or up to a space, the next field or closing marks.
_NAMED = "(?<![A-Za-z0-9])(?i:" + "|".join(SECRET_WORDS) + r")[\"'`]?\s{0,3}(?:=>|[=:])\s{0,3}"
_FIELD_END = r"[&,;][\w\"'-]+[=:]|</|[,;.)\]}]+(?:\s|\z)"
_VALUE = "|".join(
    [rf"(?<={_NAMED}{q})[^{q}\s]{{6,}}" for q in "\"'`"]
    + [rf"(?<={_NAMED})(?![\"'`=>])(?:(?!{_FIELD_END})\S){{6,}}"]
)
# The short lookbehinds come first, so names are only looked for after = or :.
CANDIDATE = (
    rf"(?<=[=:>\s\"'`])(?<=[=:>]\s{{0,3}}[\"'`]?)(?:{_VALUE})"
    r"|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![\w\"'`+/=]))?"
)


def _any(words: list[str]) -> str:
    return "(?i)(?<![a-z0-9])(" + "|".join(words) + ")(?![a-z0-9])"


def _share(value: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kind}]", "")) / F.length(value)


def features() -> dict[str, Column]:
    """Numbers that describe the columns value, before and after."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    near = F.right(before, F.lit(24))
    return {
        "size": F.length(value),
        "changes": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / F.length(value),
        "coverage": 1 - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / F.length(value),
        "digits": _share(value, "0-9"),
        "uppers": _share(value, "A-Z"),
        "vowels": _share(value, "aeiouyAEIOUY"),
        "marks": 1 - _share(value, "A-Za-z0-9"),
        "distinct": F.size(F.array_distinct(F.split(F.lower(value), ""))) / F.length(value),
        "hex": value.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "base32": value.rlike("^[0-9A-Z]+$"),
        "dashes": F.length(F.regexp_replace(value, "[^_-]", "")),
        "path": before.rlike(r"[\w.-]/$|://\S*$|[\w-]\.$") | value.rlike("/.*/") | after.rlike(r"^\.[a-z]{2,4}\b|^/\w"),
        "address": after.rlike("^@") | before.rlike("@$"),
        "named": near.rlike(_any(SECRET_WORDS) + r"[\s\"'`]*(is|=|:|=>)?[\s\"'`]*$"),
        "plain": near.rlike(_any(PLAIN_WORDS) + r"\W{0,4}$"),
        "assigned": before.rlike(r"[=:]\s*[\"'`]?$"),
        "quoted": before.rlike("[\"'`]$"),
        "issued": value.rlike("^(A[KS]IA[A-Z2-7]{16}$|gh[pousr]_|sk[-_]|xox[abprs]-|AIza)"),
    }


def _assembled(findings: DataFrame) -> DataFrame:
    numbers = {name: column.cast("double") for name, column in features().items()}
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(findings.withColumns(numbers))


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """value, before, after and label (1.0 a secret), made by rules from the row's number."""
    i, hexes = F.col("id").cast("string"), F.col("hexes")
    word = F.get(F.array(*[F.lit(w) for w in DICTIONARY]), F.pmod(F.xxhash64("id"), F.lit(len(DICTIONARY))).cast("int"))
    other = F.get(F.array(*[F.lit(w) for w in DICTIONARY]), F.pmod(F.xxhash64(i), F.lit(len(DICTIONARY))).cast("int"))
    mixed = F.regexp_replace(F.base64(F.unhex(hexes)), "[=]", "")
    number = F.translate(hexes, "abcdef", "012345")
    base32 = F.regexp_replace(F.upper(F.translate(hexes, "0189", "GMKQ")), "[^A-Z0-9]", "")
    named = F.get(F.array(*[F.lit(w) for w in SECRET_WORDS]), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(len(SECRET_WORDS))).cast("int"))
    plain = F.get(F.array(*[F.lit(w) for w in PLAIN_WORDS]), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(len(PLAIN_WORDS))).cast("int"))
    prose = F.concat_ws(" ", other, word, F.lit(""))
    length = 16 + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(49)).cast("int")
    short = 6 + F.pmod(length, F.lit(7))
    letters = F.regexp_replace(mixed, "[^A-Za-z]", "")
    capitals = F.regexp_replace(F.translate(base32, "ABCDEF", "JRTVXZ"), "[0-9]", "")
    lowers = F.translate(hexes, "0123456789abcdef", "qwrtzpsdfghjkeio")
    marked = F.concat(F.substring(mixed, 1, 2), F.lit("@"), F.substring(mixed, F.lit(3), short - 4), F.lit("!."), F.substring(mixed, 40, 1))
    spoken = F.col("spoken")
    syllables = F.array_join(
        F.transform(
            F.sequence(F.lit(1), 6 + F.pmod(length, F.lit(5))),
            lambda j: F.concat(
                F.translate(F.substring(hexes, j, F.lit(1)), "0123456789abcdef", "bdfgklmnprstvczh"),
                F.translate(F.substring(hexes, j + 64, F.lit(1)), "0123456789abcdef", "aeiouaeiouaeiern"),
            ),
        ),
        "",
    )
    # (label, before, value, after)
    cases = [
        (1, F.concat(prose, named, F.lit("=")), F.substring(hexes, F.lit(1), length), F.lit(" ")),
        (1, F.concat(prose, named, F.lit(' = "')), F.substring(hexes, F.lit(1), length), F.lit('" ')),
        (1, F.concat(prose, named, F.lit(": ")), F.substring(mixed, F.lit(1), length), F.lit("\n")),
        (1, F.concat(prose, named, F.lit("='")), F.substring(F.upper(hexes), F.lit(1), length), F.lit("'")),
        (1, prose, F.concat(F.lit("AKIA"), F.substring(base32, 1, 16)), F.lit(" ") ),
        (1, prose, F.concat(F.lit("ASIA"), F.substring(F.translate(base32, "ABCDEF", "JRTVXZ"), 1, 16)), F.lit(".")),
        (1, prose, F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), F.lit(" ")),
        (1, prose, F.substring(mixed, F.lit(1), length + 12), F.lit(" ")),
        (1, prose, F.concat(F.lit("AKIA"), F.substring(capitals, 1, 16)), F.lit(" ")),
        (1, prose, F.substring(letters, F.lit(1), 20 + F.pmod(length, F.lit(13))), F.lit(" ")),
        (1, F.concat(prose, named, F.lit("=")), F.substring(mixed, F.lit(1), short), F.lit(" ")),
        (1, F.concat(prose, named, F.lit(": ")), marked, F.lit(" ")),
        (1, F.concat(prose, named, F.lit('="')), F.substring(letters, F.lit(1), short), F.lit('" ')),
        (1, F.concat(prose, named, F.lit("=")), F.substring(lowers, F.lit(1), short + 2), F.lit(" ")),
        (0, prose, spoken, F.lit(" ")),
        (0, prose, F.initcap(spoken), F.lit(", ")),
        (0, prose, F.upper(spoken), F.lit("!! ")),
        (0, prose, F.upper(F.concat_ws("_", word, other, word)), F.lit(" ")),
        (0, prose, F.concat_ws("-", word, spoken, other), F.lit(" ")),
        (0, prose, F.concat(word, F.initcap(other), F.initcap(word)), F.lit("(")),
        (0, prose, F.concat_ws("_", F.lit("aws"), named, other), F.lit("=")),
        (0, F.concat(prose, named, F.lit(": ")), F.concat(word, other), F.lit(" ")),
        (0, F.concat(prose, F.lit("Authorization: ")), F.lit("Bearer"), F.lit(" ")),
        (0, F.concat(prose, named, F.lit("=")), F.concat(F.lit("${"), F.upper(word), F.lit("}")), F.lit(" ")),
        (0, F.concat(prose, named, F.lit(": ")), F.repeat(F.lit("*"), 8), F.lit(" ")),
        (0, prose, F.substring(number, 1, 16), F.lit(" ")),
        (0, prose, F.substring(number, F.lit(1), F.pmod(length, F.lit(9)) + 12), F.lit(" ")),
        (0, prose, F.concat_ws("-", word, other, F.substring(number, 1, 4)), F.lit(" ")),
        (0, prose, F.concat_ws("_", word, other, word, F.substring(number, 1, 2)), F.lit(" ")),
        (0, F.concat(prose, F.lit("https://example.com/")), F.concat_ws("/", word, F.substring(hexes, 1, 12)), F.lit(".js")),
        (0, F.concat(prose, plain, F.lit(" ")), F.substring(hexes, 1, 40), F.lit(" ")),
        (0, F.concat(prose, plain, F.lit(": ")), F.substring(hexes, 1, 32), F.lit(" ")),
        (0, prose, F.concat(word, other, F.substring(number, 1, 3)), F.lit("@example.com")),
        (0, F.concat(prose, named, F.lit(" = ")), F.concat(F.repeat(F.substring(number, 1, 1), 8), F.lit("x" * 8)), F.lit(" ")),
        (0, F.concat(prose, named, F.lit('="')), F.concat_ws("-", F.lit("your"), word, F.lit("here"), F.substring(number, 1, 1)), F.lit('"')),
        (0, prose, F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 12)), F.lit(" ")),
        (0, F.concat(prose, F.lit("2024-01-")), F.concat(F.substring(number, 1, 8), F.lit("T"), F.substring(number, 9, 6)), F.lit(" ")),
    ]
    entry = [
        F.struct(F.lit(float(label)).alias("label"), before.alias("before"), value.alias("value"), after.alias("after"))
        for label, before, value, after in cases
    ]
    picked = F.get(F.array(*entry), F.pmod("id", F.lit(len(cases))).cast("int"))
    drawn = spark.range(0, rows, 1, 2).withColumn("hexes", F.sha2(i, 512)).withColumn("spoken", syllables)
    # Written once, else the forest's passes and each feature work out all cases again.
    drawn = kept_table(spark, drawn, "drawn")
    return drawn.select(picked.alias("x")).select("x.*").where(F.length("value") >= 6)


def fit(spark: SparkSession, findings: DataFrame | None = None) -> RandomForestClassificationModel:
    """A forest on labelled findings (value, before, after, label), by default those made by rule."""
    rows = _assembled(findings if findings is not None else kept_table(spark, labelled_findings(spark), "examples"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=TREE_DEPTH, seed=7)
    return forest.fit(rows.select("features", "label"))


def candidate_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, place, value, before and after of every candidate of every row."""
    # What stands around a value goes on over other candidates, which can be its name.
    parts, values = F.col("parts"), F.col("values")
    text = lambda array, at: F.coalesce(F.get(array, at), F.lit(""))
    beside = lambda i, steps: [x for k in steps for x in (text(parts, i + k), text(values, i + k))]
    found = F.transform(
        values,
        lambda v, i: F.struct(
            i.alias("place"),
            v.alias("value"),
            F.right(F.concat(*beside(i, (-3, -2, -1)), text(parts, i)), F.lit(BEFORE)).alias("before"),
            F.left(F.concat(*beside(i, (1, 2)), text(parts, i + 3)), F.lit(AFTER)).alias("after"),
        ),
    )
    rows = docs.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id",
        row_key().alias("row_key"),
        F.split("text", CANDIDATE).alias("parts"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"),
    )
    return rows.select("doc_id", "row_key", F.inline(found))


def findings(spark: SparkSession, docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """candidate_rows with ``score`` and ``secret``."""
    model = model or fit(spark)
    scored = model.transform(_assembled(candidate_rows(docs)))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "row_key", "place", "value", "before", "after", score.alias("score")).withColumn(
        "secret", F.col("score") >= 0.5
    )


def masked(text: Column, secret_places: Column) -> Column:
    """The text with the candidates at these places replaced."""
    parts = F.split(text, CANDIDATE)
    values = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    shown = F.transform(values, lambda v, i: F.when(F.array_contains(secret_places, i), F.lit(MASK)).otherwise(v))
    return F.array_join(F.zip_with(parts, shown, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with secrets masked in text, and __n_candidates and __n_secrets.

    Only rows with candidates travel to meet their findings.
    """
    found = kept_table(spark, findings(spark, docs), "findings")
    places = found.groupBy("doc_id", "row_key").agg(
        F.countDistinct("place").alias("__n_candidates"),
        F.array_sort(F.collect_set(F.when(F.col("secret"), F.col("place")))).alias("__places"),
    )
    some = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    none = F.lit(0).cast("bigint")
    quiet = docs.where(~some).withColumns({"__n_candidates": none, "__n_secrets": none})
    joined = with_results(docs.where(some).withColumn("row_key", row_key()), places).drop("row_key")
    text = F.when(F.size("__places") > 0, masked(F.col("text"), F.col("__places"))).otherwise(F.col("text"))
    marked = joined.withColumns({"__n_secrets": F.size("__places").cast("bigint"), "text": text}).drop("__places")
    return quiet.unionByName(marked)


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    rows = scanned(spark, docs.select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.col("__n_candidates").alias("n_candidates"),
        F.col("__n_secrets").alias("n_secrets"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("masked_sha256"),
    )


def masked_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their own columns and secrets masked in text."""
    kept = docs.withColumnRenamed("row_key", "__own_row_key") if "row_key" in docs.columns else docs
    rows = scanned(spark, kept).drop("__n_candidates", "__n_secrets")
    return rows.withColumnRenamed("__own_row_key", "row_key").select(docs.columns)
