"""Secret scans whose false positives a random forest removes (operator 1)."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RUN, boxed, materialize, unboxed
from .labelled import WORDS, Finding, made

#: Each such run of a word is a candidate.
RUN = "[A-Za-z0-9_+/=-]{16,}"
#: So many characters of what stands around a run are looked at.
NEAR = 200
CUES = "(?i)pass|pwd|secret|token|key|auth|bearer|cred"
HARMLESS = "(?i)commit|revision|sha[0-9]|md5|checksum|etag|digest|hash|uuid|_id|build|merge|version|tree|fingerprint|object|index|base64|integrity"
FEATURES = ("length", "transitions", "bigrams", "coverage", "digits", "upper", "separators", "hexadecimal", "variety", "path", "cue_before", "cue_inside", "cue_after", "cue_nearest", "harmless_before", "harmless_inside", "harmless_after", "harmless_nearest", "assigned")


def candidates(docs: DataFrame) -> DataFrame:
    """Adds `found`: for each run of each word the word's place, its own place among the word's runs, itself, the text
    around it within the word, and the two words before and after.

    `lead` is what stands between the run before and this one, with the end of that run in `prior`; `trail` is what
    stands between this run and the next. All of them are cut to NEAR characters, so that long words stay linear.
    """
    split = docs.withColumn("_words", F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE_RUN), ""))
    words = f"""filter(transform(_words, (w, i) -> if(length(w) >= 16 and w rlike '{RUN}', named_struct(
        'at', i, 'runs', regexp_extract_all(w, '{RUN}', 0), 'gaps', split(w, '{RUN}', -1),
        'before', right(concat_ws(' ', try_element_at(_words, if(i > 1, i - 1, null)), try_element_at(_words, if(i > 0, i, null))), {NEAR}),
        'after', left(concat_ws(' ', try_element_at(_words, i + 2), try_element_at(_words, i + 3)), {NEAR})), null)), c -> c is not null)"""
    found = f"""flatten(transform({words}, c -> transform(c.runs, (r, j) -> named_struct(
        'at', c.at, 'nth', j, 'run', r, 'prior', if(j > 0, right(c.runs[j - 1], {NEAR}), ''), 'lead', right(c.gaps[j], {NEAR}), 'trail', left(c.gaps[j + 1], {NEAR}), 'before', c.before, 'after', c.after))))"""
    return split.withColumn("found", F.expr(found)).drop("_words")


class Lexicon(NamedTuple):
    """The dictionary, and ln P(letter | letter before) of its words, in ten-thousandths, for 26 x 26 letters."""

    words: list[str]
    bigrams: list[int]


def lexicon(docs: DataFrame, words: int) -> Lexicon:
    """The `words` most frequent words of three to eight letters of all documents, and the fixed words of names."""
    frequent = docs.select(F.explode(F.split(F.lower("text"), SPACE_RUN)).alias("w")).where("w rlike '^[a-z]{3,8}$'")
    found = [r.w for r in frequent.groupBy("w").count().orderBy(F.desc("count"), "w").limit(words).collect()]
    both = list(dict.fromkeys([*found, *WORDS]))
    counts = [[1] * 26 for _ in range(26)]
    for w in (w for w in both if w.isascii() and w.isalpha()):
        for a, b in zip(w, w[1:]):
            counts[ord(a) - 97][ord(b) - 97] += 1
    return Lexicon(both, [round(1e4 * math.log(n / sum(row))) for row in counts for n in row])


def described(known: Lexicon) -> str:
    """SQL for the features of a candidate x: length, character transitions, dictionary coverage, path, neighbours."""
    words = "|".join(sorted(known.words, key=lambda w: (-len(w), w)))
    edges = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    around = "concat(x.prior, x.lead, ' ', x.trail)"
    nearest = "regexp_extract(concat(x.before, ' ', x.prior, x.lead), '([A-Za-z0-9_]+)[^A-Za-z0-9_]*$', 1)"
    share = lambda letters: f"1 - length(regexp_replace(x.run, '{letters}', '')) / length(x.run)"
    pairs = "filter(transform(sequence(1, length(x.run) - 1), i -> translate(lower(substring(x.run, i, 2)), '0123456789_+/=-', '')), p -> length(p) = 2)"
    table = f"array({', '.join(map(str, known.bigrams))})"
    features = {
        "length": "double(length(x.run))",
        "transitions": f"(length(regexp_replace(x.run, '{edges}', '#')) - length(x.run)) / length(x.run)",
        "bigrams": f"aggregate(array({pairs}), -1e5D, (none, ps) -> if(size(ps) = 0, none, aggregate(ps, 0L, (s, p) -> s + {table}[(ascii(p) - 97) * 26 + ascii(substring(p, 2, 1)) - 97]) / size(ps)))",
        "coverage": f"1 - length(regexp_replace(lower(x.run), '{words}', '')) / length(x.run)",
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "separators": share("[_+/=-]"),
        "hexadecimal": "double(x.run rlike '^([0-9a-f]+|[0-9A-F]+)$')",
        "variety": "size(array_distinct(split(x.run, ''))) / length(x.run)",
        "path": "double(length(concat(x.lead, x.run, x.trail)) - length(regexp_replace(concat(x.lead, x.run, x.trail), '[/.@:]', '')))",
        "cue_before": f"double(x.before rlike '{CUES}')",
        "cue_inside": f"double({around} rlike '{CUES}')",
        "cue_after": f"double(x.after rlike '{CUES}')",
        "cue_nearest": f"double({nearest} rlike '{CUES}')",
        "harmless_before": f"double(x.before rlike '{HARMLESS}')",
        "harmless_inside": f"double({around} rlike '{HARMLESS}')",
        "harmless_after": f"double(x.after rlike '{HARMLESS}')",
        "harmless_nearest": f"double({nearest} rlike '{HARMLESS}')",
        "assigned": "double(x.before rlike '[=:]$' or concat(x.prior, x.lead) rlike '[A-Za-z][^A-Za-z0-9]?[=:]' or x.lead rlike '[=:][^A-Za-z0-9]*$' or x.run rlike '^[A-Za-z_]{3,}=')",
    }
    return "named_struct(" + ", ".join(f"'{k}', {features[k]}" for k in FEATURES) + ")"


class SecretForest:
    """A random forest over the features, as SQL: trees are nested CASEs, so that scoring needs no join and no Python."""

    def __init__(self, known: Lexicon, trees: list[str]):
        self.known, self.trees = known, trees

    @property
    def probability(self) -> str:
        """SQL over a struct f of the features."""
        return f"({' + '.join(self.trees)}) / {len(self.trees)}"

    @staticmethod
    def tree(node) -> str:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return f"{stats[1] / sum(stats):.6f}D"
        split = node.split()
        return f"CASE WHEN f.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D THEN {SecretForest.tree(node.leftChild())} ELSE {SecretForest.tree(node.rightChild())} END"


def labelled_candidates(spark: SparkSession, lines: list[Finding]) -> DataFrame:
    """run, label, x of the labelled runs of made-up lines."""
    table = spark.createDataFrame([(f.text, list(f.runs), float(f.label)) for f in lines], "text string, runs array<string>, label double")
    found = candidates(table).select("runs", "label", F.explode("found").alias("x"))
    return found.where("array_contains(runs, x.run)").select("x.run", "label", F.col("x").dropFields("at", "nth").alias("x"))


def train(docs: DataFrame, labels: DataFrame | None = None, *, max_findings: int = 10_000, made_up: int = 6_000, trees: int = 30, depth: int = 8, words: int = 400, seed: int = 5, without: tuple[str, ...] = ()) -> SecretForest:
    """Fits the forest on labelled findings.

    labels: run, label (1 a secret, 0 none), for runs in docs; a run found in several places counts by its least
    surroundings, and of more than `max_findings` of a label those with the lowest hashes count. `made_up` findings
    of `labelled` are learned beside them (but not the families in `without`), so that the forest always knows both
    kinds; a table without labels is judged by these alone. The dictionary is drawn from all documents.
    """
    spark = docs.sparkSession
    known = lexicon(docs, words)
    both = labelled_candidates(spark, made(known.words, made_up, seed, without)).select("run", "label", "x")
    if labels is not None:
        named = labels.where("label in (0, 1)").select("run", F.col("label").cast("double").alias("label")).dropDuplicates(["run"])
        found = candidates(docs.select("text")).select(F.explode("found").alias("x")).select("x.run", F.col("x").dropFields("at", "nth").alias("x"))
        found = materialize(found.join(named, "run").groupBy("run", "label").agg(F.min("x").alias("x")).withColumn("hash", F.xxhash64("run")))
        for label, n in sorted((r.label, r["count"]) for r in found.groupBy("label").count().collect()):
            # half as many again as are taken pass this, so that the task that takes them doesn't see what grows with docs
            cut = min((1 << 63) - 1, int((1.5 * max_findings + 200) / n * (1 << 64)) - (1 << 63))
            both = both.unionByName(found.where((F.col("label") == label) & (F.col("hash") <= F.lit(cut).cast("long"))).orderBy("hash", "run").limit(max_findings).drop("hash"))
    both = both.orderBy("run", "label").coalesce(1)  # bounded; the order makes reruns agree
    both = both.select("label", F.expr(described(known)).alias("f")).select("label", *(F.col(f"f.{c}") for c in FEATURES))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(both).select("label", "features")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5).fit(materialize(rows))
    return SecretForest(known, [SecretForest.tree(t._java_obj.rootNode()) for t in model.trees])


def scanned(docs: DataFrame, forest: SecretForest, threshold: float = 0.5) -> DataFrame:
    """Adds `secrets`: the candidates of each text with their score, and whether they are kept as findings."""
    scored = f"""transform(transform(found, x -> named_struct('x', x, 'f', {described(forest.known)})),
        y -> named_struct('at', y.x.at, 'nth', y.x.nth, 'run', y.x.run, 'score', transform(array(y.f), f -> {forest.probability})[0]))"""
    return candidates(docs).withColumn("secrets", F.expr(f"transform({scored}, s -> named_struct('at', s.at, 'nth', s.nth, 'run', s.run, 'score', s.score, 'is_secret', s.score >= {threshold}))")).drop("found")


def findings(docs: DataFrame, forest: SecretForest | None = None, **options) -> DataFrame:
    """A row per candidate: doc_id, word_at and run_at (its word, and its place among the runs of that word, from 0), length, run_sha256, score, is_secret.

    Null and empty texts have no candidates; each row is scanned by itself (repeated rows and null ids stay); columns
    besides doc_id and text are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    out = scanned(docs, forest or train(docs, **options)).select("doc_id", F.explode("secrets").alias("s"))
    return out.select("doc_id", F.col("s.at").cast("long").alias("word_at"), F.col("s.nth").cast("long").alias("run_at"), F.length("s.run").cast("long").alias("length"), F.sha2("s.run", 256).alias("run_sha256"), F.round("s.score", 6).alias("score"), "s.is_secret")


def redacted(docs: DataFrame, forest: SecretForest | None = None, mask: str = "[SECRET]", **options) -> DataFrame:
    """docs with each finding's run replaced by `mask`, wherever it stands in its text; no document goes.

    Longer runs go first: one that another holds would else break the other up, and its rest would stay.
    """
    out = scanned(boxed(docs, "text"), forest or train(docs, **options))
    runs = "array_sort(array_distinct(transform(filter(secrets, s -> s.is_secret), s -> s.run)), (a, b) -> length(b) - length(a))"
    text = F.expr(f"aggregate({runs}, text, (t, r) -> replace(t, r, '{mask}'))")
    return unboxed(out, docs.columns, text=text)
