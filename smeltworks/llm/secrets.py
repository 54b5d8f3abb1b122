"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame operations only.

A text is cut at its candidates once, so that each comes with its position and with the text before and after it. The forest
sees the candidate's length and make-up, its transitions between kinds of characters, how much of it words cover that many
documents of the corpus use, the path it was found under and the neighbouring words. It is trained from labelled findings; where none are given, findings
of well-known key formats, or assigned to a telling name, are the positive ones, and plain numbers, identifiers and
words the negative ones. The rest are left to the forest.
"""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

# Names that secrets are assigned to.
SECRET_NAMES = r"(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[a-z]{0,12}|credential|private[_-]?key)"

# Blocks of a private key, signed tokens, passwords in URLs, any value assigned to a telling name, and runs of key characters that hold
# a digit or are all capitals.
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]++-----END [A-Z ]{0,40}PRIVATE KEY-----)?"
SIGNED = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]*"
IN_URL = r"(?<=:)(?<=://[^\s:/@]{1,40}:)[^\s:/@]+(?=@)"
ASSIGNED = (
    r"(?<=[=:\s\"'])(?<=[:=]\s{0,2}[\"']?)(?<=" + SECRET_NAMES + r"[A-Za-z_-]{0,12}[\"']?\s{0,2}[:=]\s{0,2}[\"']?)"
    r"[^\s\"'<>,;(){}\[\]]{3,}[^\s\"'<>,;(){}\[\].]"
)
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9]|[A-Z]{16})[A-Za-z0-9+/_-]{12,}={0,2}"
CANDIDATE = "|".join((PEM, SIGNED, IN_URL, ASSIGNED, RUN))
CONTEXT = 60

# Public formats of keys, names of harmless numbers.
KEY_FORMATS = (
    r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^[sr]k_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
    r"|^-----BEGIN|^eyJ[A-Za-z0-9_-]+\.eyJ"
)
HARMLESS_NAMES = r"(?i)\b(?:commit|sha\d*|md5|uuid|guid|hash|order|isbn|version|build|invoice|phone|tel|fax|id|ref)\b"
SAMPLE_PATHS = r"(?i)test|example|sample|mock|fixture|doc"
# The dictionary: words that most documents use, so many at most, each in so many documents at least.
DICTIONARY_WORDS = 3000
DICTIONARY_DOCUMENTS = 3

# Bound of the training sample, rows needed of either class, and the share of votes that makes a secret.
SAMPLE = 20_000
LEAST_EXAMPLES = 10
VOTES = 0.5
SEED = 7


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """``(doc_id, path, start, end, candidate, before, after)``, positions in code points, the end exclusive."""
    where = F.col(path).cast("string") if path else F.lit("")
    cut = docs.where(F.col(text).rlike(CANDIDATE)).select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(where, F.lit("")).alias("path"),
        F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split(F.col(text), CANDIDATE, -1).alias("between"),
    )
    # Running length of "text between, candidate" pairs.
    lengths = F.zip_with(F.slice("between", F.lit(1), F.size("found")), "found", lambda b, f: F.struct(F.length(b).alias("b"), F.length(f).alias("f")))
    starts = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts")),
        lambda s, x: F.struct((s["at"] + x["b"] + x["f"]).alias("at"), F.array_append(s["starts"], s["at"] + x["b"]).alias("starts")),
    )["starts"]
    rows = cut.select("doc_id", "path", "between", F.posexplode(F.arrays_zip("found", starts.alias("starts"))).alias("n", "hit"))
    return rows.select(
        "doc_id",
        "path",
        F.col("hit.starts").cast("bigint").alias("start"),
        (F.col("hit.starts") + F.length("hit.found")).cast("bigint").alias("end"),
        F.col("hit.found").alias("candidate"),
        F.right(F.get("between", "n"), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("between", F.col("n") + 1), F.lit(CONTEXT)).alias("after"),
    )


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS, least: int = DICTIONARY_DOCUMENTS) -> list[str]:
    """The ``words`` words of four and more letters that most documents use, whatever their case; ties go by the alphabet.

    Counted over whole texts of all documents, each word once per document; words of candidates count like others.
    """
    used = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]{4,}"), F.lit(0)))).alias("word"))
    often = used.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return [r["word"] for r in often.orderBy(F.desc("n"), "word").limit(words).collect()]


def _share(pattern: str) -> Column:
    c = F.col("candidate")
    return (F.length(c) - F.length(F.regexp_replace(c, pattern, ""))) / F.length(c)


def features(words: list[str]) -> dict[str, Column]:
    """What the forest sees of a candidate, with ``words`` as dictionary."""
    c, n = F.col("candidate"), F.length("candidate")
    near = F.regexp_extract(F.col("before"), r"((?:\S+\s+)?\S*\s*)$", 1)
    around = F.concat_ws(" ", near, F.regexp_extract(F.col("after"), r"^\S*\s+(\S+)", 1))
    symbols = F.array_distinct(F.split(c, ""))
    share = F.transform(symbols, lambda s: (n - F.length(F.replace(c, s, F.lit("")))) / n)
    lower = F.lower(c)
    parts = F.regexp_extract_all(c, F.lit("[A-Z]?[a-z]{3,}|[A-Z]{4,}"), F.lit(0))
    known = F.filter(parts, lambda w: F.lower(w).isin(words)) if words else F.array().cast("array<string>")
    return {
        "length": n,
        "digits": _share("[0-9]"),
        "capitals": _share("[A-Z]"),
        "small": _share("[a-z]"),
        "hex": _share("[0-9a-f]"),
        "marks": _share("[^A-Za-z0-9]"),
        "kinds_of_symbol": F.size(symbols) / n,
        "entropy": F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0)),
        "to_digit": F.regexp_count(c, F.lit("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")) / n,
        "to_capital": F.regexp_count(c, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / n,
        "to_mark": F.regexp_count(c, F.lit("(?<=[A-Za-z0-9])(?=[^A-Za-z0-9])")) / n,
        "repeats": F.regexp_count(c, F.lit(r"(.)\1")) / n,
        "vowels": F.regexp_count(lower, F.lit("[aeiou]")) / n,
        "dictionary": F.length(F.array_join(known, "")) / n,
        "key_format": c.rlike(KEY_FORMATS),
        "uuid": lower.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "in_url": F.col("before").rlike("://[^\\s:/@]+:$") & F.col("after").startswith("@"),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "secret_name": around.rlike(SECRET_NAMES),
        "harmless_name": around.rlike(HARMLESS_NAMES),
        "plain_before": F.col("before").rlike(r"(?:^|\s)[A-Za-z]+\s$"),
        "sample_path": F.col("path").rlike(SAMPLE_PATHS),
        "path_depth": F.regexp_count(F.col("path"), F.lit("/")),
    }


def described(found: DataFrame, words: list[str]) -> DataFrame:
    return found.select("*", F.struct(*[v.cast("double").alias(k) for k, v in features(words).items()]).alias("f"))


def weak_label() -> Column:
    """1 for findings that are secrets by their format, place or name, 0 for harmless ones, null where neither is plain.

    A dictionary word after a telling name ("token: value") is harmless.
    """
    f = F.col("f")
    named = F.col("before").rlike(SECRET_NAMES + r"[A-Za-z_-]{0,12}[\"']?\s*[=:]\s*[\"']?$") | (f["in_url"] == 1)
    worded = f["dictionary"] >= 0.6
    harmless = (f["digits"] == 1) | (f["uuid"] == 1) | worded | ((f["harmless_name"] == 1) & ~named)
    return F.when((f["key_format"] == 1) | (named & ~worded), 1.0).when(harmless, 0.0)


def train(findings: DataFrame, label: Column, sample: int = SAMPLE) -> PipelineModel | None:
    """A forest from ``described`` findings with labels, on a bounded sample; None if a class is too small to learn from."""
    names = findings.schema["f"].dataType.names
    labelled = findings.withColumn("label", label).where("label IS NOT NULL").select("label", *[F.col(f"f.{k}").alias(k) for k in names])
    drawn = materialise(labelled.orderBy(F.xxhash64(*labelled.columns), *labelled.columns).limit(sample).coalesce(1), "labelled")
    counts = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_EXAMPLES:
        return None
    vector = VectorAssembler(inputCols=names, outputCol="v", handleInvalid="keep")
    forest = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=40, maxDepth=8, seed=SEED, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[vector, forest]).fit(drawn)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", findings: DataFrame | None = None) -> DataFrame:
    """One row per candidate: ``doc_id, start, end, candidate, score, is_secret``.

    ``findings``: labelled candidates ``(path, candidate, before, after, label)``; without them the labels come from the scanned
    corpus. ``score`` is the forest's share of votes; with too few labels for a forest, candidates with a positive
    label score 1 and all others 0. Null and empty texts have no candidates; a null path counts as an empty one; repeated rows
    give repeated findings. Other columns are not read.
    """
    words = dictionary(docs, text)
    found = materialise(described(candidates(docs, doc_id, text, path), words), "candidates")
    if findings is None:
        model, label = train(found, weak_label()), weak_label()
    else:
        model, label = train(described(findings, words), F.col("label")), weak_label()
    if model is None:
        scored = found.withColumn("score", F.coalesce(label, F.lit(0.0)))
    else:
        flat = found.select("*", *[F.col(f"f.{k}").alias(k) for k in found.schema["f"].dataType.names])
        scored = model.transform(flat).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "start", "end", "candidate", "score", (F.col("score") >= VOTES).alias("is_secret"))
