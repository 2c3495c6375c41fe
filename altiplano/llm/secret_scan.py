"""Secret scans: regex candidates, and a random forest that removes false positives.  No Python on the executors.

A candidate is what is assigned to a secret-like name (6 or more characters up to white space or a quote, under names of
any prefix), a web token of three dotted parts, or a run of 12 or more token characters with a digit.  The forest sees
its length and character classes, the transitions between its characters, how much of it dictionary words cover, whether
it is part of a path, and the words beside it.  The dictionary is the corpus's own vocabulary (words of at least
MIN_DOCS documents, as a Bloom table) beside a few common words of identifiers, and the transitions are scored by the
letter pairs of that vocabulary.  The forest is fitted on labelled findings (TRAIN_ROWS of them, from a seeded grammar
over the corpus's words, or given by the caller) whose features come from the same column expressions.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bloom, let, maybe_in, named, staged

#: Labelled findings made for a fit, half of them secrets, and corpus words (from MIN_DOCS documents or more) they use.
TRAIN_ROWS, TRAIN_WORDS, MIN_DOCS = 4000, 400, 5
TREES, DEPTH, SEED = 40, 8, 11
BEFORE, AFTER = 40, 12

#: Names that secrets are assigned to, words beside what is none, and common words of identifiers.
SECRET_NAMES = "password passwd pwd secret token apikey api_key api-key access_key accesskey auth credential private_key client_secret bearer"
PLAIN_WORDS = "commit sha sha1 sha256 md5 checksum digest hash uuid guid version release build id ref revision tag order invoice serial isbn etag integrity example sample placeholder card"
DICTIONARY = "the and for with from this that name user item list test file path data main class image example sample config server client value index model table query string number object method function return import export module package system network process thread event error message request response session account order product price page post title content version release build update create delete search filter sort group count total first last next open close start stop true false none null default your here change placeholder password secret token key access public private local remote linux windows android python java script style static assets vendor lib usr bin src home docs html json text node get set has make find load save read write"

_NAME = "|".join(x.replace("-", "[-]") for x in SECRET_NAMES.split())
_VALUE = r"[^\s\"'`,;<>()\[\]{}]{5,199}[^\s\"'`,;<>()\[\]{}.:!?]"
#: A name is looked for only in a run of name characters, from its beginning, that a : or = follows; a token begins where
#: its run does.
_ASSIGNED = rf"(?<![\w.\-])(?=[\w.\-]{{3,100}}+[\"']?\s{{0,3}}[:=])[\w.\-]{{0,60}}?(?i:{_NAME})\w{{0,20}}[\"']?\s{{0,3}}[:=]>?\s{{0,3}}[\"']?"
_TOKEN = r"(?<![A-Za-z0-9+/_\-])(?:eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}|[A-Za-z0-9+/_\-]{12,}+={0,2})"
_CANDIDATE = rf"{_ASSIGNED}{_VALUE}|{_TOKEN}"
#: Stands around each match in a text that is scanned; where a text has it, it is read as the next character.
_MARK, _FOR_MARK = "\u0001", "\u0002"
_SMALL = "[a-z]{3,20}"
FEATURES = ("length", "digits", "upper", "lower", "other", "distinct", "letter_digit", "digit_letter", "lower_upper", "upper_lower", "pair_odds", "vowels", "consonant_run", "same_run", "hex", "all_digits", "uuid", "dictionary", "named", "name_before", "plain_before", "plain_after", "quoted", "slashes", "slash_before", "extension", "dashes", "symbols", "source_path")


@dataclass
class Lexicon:
    """What the corpus says of words: a Bloom table, log-odds of letter pairs (27 * 27, `{` for an edge), some words."""

    table: DataFrame
    blocks: int
    odds: list[float] = field(repr=False)
    words: list[str] = field(repr=False)


def lexicon(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS) -> Lexicon:
    """The vocabulary of all texts: words of 3 to 20 letters a-z, lowered, in at least min_docs documents.

    A document counts a word once, and counts are summed by task before they are shuffled.  What comes to the driver is
    bounded: 27 * 27 sums and TRAIN_WORDS words (those of the least hashes).
    """
    own = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(named(text_col), F.lit(""))), "[^a-z]+"), lambda w: F.length(w).between(3, 20)))
    known = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("word")
    common = docs.sparkSession.createDataFrame([(w,) for w in sorted(set(DICTIONARY.split())) if len(w) > 2], "word string")
    words = staged(known.unionByName(common).distinct(), "secrets-words")
    table, blocks = bloom(words, "word", words.count())
    pair = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substr(w, i, F.lit(2)))
    pairs = words.select(F.explode(pair(F.concat(F.lit("{"), "word", F.lit("{")))).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
    n = [0.5] * (27 * 27)
    for r in pairs:
        n[(ord(r["p"][0]) - 97) * 27 + ord(r["p"][1]) - 97] += r["n"]
    total = [sum(n[a * 27 : a * 27 + 27]) for a in range(27)]
    # against letters drawn evenly
    odds = [round(math.log(27 * n[i] / total[i // 27]), 4) for i in range(27 * 27)]
    some = [r["word"] for r in words.orderBy(F.xxhash64("word"), "word").limit(TRAIN_WORDS).collect()]
    return Lexicon(table, blocks, odds, some)




def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _letter_runs(v: Column) -> Column:
    """Runs of letters of 3 to 20, lowered: a capital after a small letter begins a new one."""
    apart = F.regexp_replace(v, "([a-z])(?=[A-Z])", "$1 ")
    return F.regexp_extract_all(F.lower(apart), F.lit(_SMALL), 0)


def covered(findings: DataFrame, words: Lexicon) -> DataFrame:
    """findings (v and others) with `dictionary`: the share of v's characters in words of the lexicon."""
    rows = findings.withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, "secrets-findings")
    runs = rows.select("row", F.explode(_letter_runs(F.col("v"))).alias("word"))
    found = maybe_in(runs, "word", words.table, words.blocks, "known").where("known").groupBy("row").agg(F.sum(F.length("word")).alias("in_words"))
    return rows.join(found, "row", "left").withColumn("dictionary", F.coalesce("in_words", F.lit(0)) / F.length("v")).drop("row", "in_words")


def features(v: Column, named: Column, before: Column, after: Column, path: Column, dictionary: Column, words: Lexicon) -> list[Column]:
    """The columns of FEATURES, as doubles, of a candidate and its context."""
    n = F.length(v).cast("double")
    lowered = F.lower(v)
    either = lambda words: rf"(?i)(?:^|[^A-Za-z0-9])(?:{words.replace(' ', '|')})(?:[^A-Za-z0-9]|$)"
    # letters are 0 to 25, everything else an edge
    odds, edged = F.array(*[F.lit(x) for x in words.odds]), F.concat(F.lit("{"), F.regexp_replace(lowered, "[^a-z]", "{"), F.lit("{"))
    place = lambda c: F.ascii(c) - 97
    score = lambda i: F.get(odds, place(F.substr(edged, i, F.lit(1))) * 27 + place(F.substr(edged, i + 1, F.lit(1))))
    pair_odds = F.aggregate(F.sequence(F.lit(1), F.length(edged) - 1), F.lit(0.0), lambda s, i: s + score(i)) / (n + 1)
    return [
        n,
        _count(v, "[0-9]") / n,
        _count(v, "[A-Z]") / n,
        _count(v, "[a-z]") / n,
        _count(v, r"[+/_\-]") / n,
        F.size(F.array_distinct(F.split(v, ""))) / n,
        _count(v, "(?<=[A-Za-z])[0-9]") / n,
        _count(v, "(?<=[0-9])[A-Za-z]") / n,
        _count(v, "(?<=[a-z])[A-Z]") / n,
        _count(v, "(?<=[A-Z])[a-z]") / n,
        pair_odds,
        _count(lowered, "[aeiou]") / n,
        _flag(lowered.rlike("[bcdfghjklmnpqrstvwxz]{5}")),
        _flag(v.rlike(r"(.)\1\1\1")),
        _flag(v.rlike("^[0-9a-f]+$") | v.rlike("^[0-9A-F]+$")),
        _flag(v.rlike("^[0-9]+$")),
        _flag(v.rlike("^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$")),
        dictionary,
        _flag(named),
        _flag(before.rlike(either(SECRET_NAMES))),
        _flag(before.rlike(either(PLAIN_WORDS))),
        _flag(after.rlike(either(PLAIN_WORDS))),
        _flag(before.rlike("[\"'`]$")),
        _count(v, "/"),
        _flag(before.rlike(r"[/.~]$|://")),
        _flag(after.rlike(r"^\.[a-z]{1,4}\b")),
        _count(v, "[-_]"),
        _count(v, r"[^A-Za-z0-9+/_\-=]") / n,
        _flag(path.rlike(r"(?i)test|example|sample|fixture|\.lock|\.min\.|vendor|node_modules")),
    ]


def labelled(words: list[str], rows: int = TRAIN_ROWS, seed: int = SEED) -> list[tuple[str, str, str, bool, str, float]]:
    """(candidate, text before, text after, named, path, label) from a seeded grammar over the words."""
    r = random.Random(seed)
    chars = lambda alphabet, n: "".join(r.choices(alphabet, k=n))
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexa, b64 = num + "abcdef", low + up + num + "+/"
    word = lambda: r.choice(words)
    prefix = lambda: r.choice(["", "", "", "db_", "DATABASE_", "aws_", "app.", "MY_", "user-"])
    lead = lambda: " ".join(word() for _ in range(r.randint(2, 5))) + " "

    def secret() -> tuple:
        named = r.random() < 0.6
        v = r.choice([
            lambda: "AKIA" + chars(up + "234567" + num, 16),
            lambda: chars(hexa, r.choice([16, 18, 20, 24, 32, 40, 64])) if named else "ghp_" + chars(low + up + num, 36),
            lambda: chars(b64, r.choice([20, 32, 40, 43])),
            lambda: chars(low + up + num, r.randint(14, 40)),
            lambda: r.choice(["sk-", "sk_live_", "xoxb-", "glpat-"]) + chars(low + up + num, r.randint(20, 40)),
            lambda: (word() + chars(num, 4) + chars(up + num + "_-", 6)) if named else "AKIA" + chars(up + num, 16),
            lambda: (chars(low, r.randint(3, 6)) + chars(num, r.randint(1, 4)) + chars("!@#$%^&*", r.randint(0, 2))) if named else "eyJ" + ".".join(chars(low + up + num, r.randint(12, 40)) for _ in range(3)),
            lambda: (chars(low + up + num + "!@#$%^&*?-_", r.randint(7, 16)) + r.choice(low + num)) if named else "xoxp-" + chars(num, 12) + "-" + chars(hexa, 24),
            lambda: "".join(word() for _ in range(r.randint(2, 3))) + r.choice(["", chars(num, 2)]) if named else "SG." + chars(low + up + num, 22),
        ])()
        name = prefix() + r.choice(SECRET_NAMES.split()) + r.choice(["=", ": ", ' = "', "='"]) if named else r.choice(["", "", "key ", "use "])
        return v, lead() + name, r.choice([" ", '" ', "'\n", ". "]) + word(), named, r.choice(["src0", "app/config.py", "src/main.js"]), 1.0

    def plain() -> tuple:
        kind = r.randrange(12)
        named, before, after = False, lead(), r.choice([" ", ". ", ", "]) + word()
        if kind == 0:
            v, before = chars(hexa, 40), before + r.choice(["commit ", "sha1: ", "revision ", "ref "])
        elif kind == 1:
            v, before = chars(hexa, r.choice([32, 64])), before + r.choice(["md5 ", "sha256:", "checksum ", "etag ", "hash "])
        elif kind == 2:
            v, before = "-".join(chars(hexa, n) for n in (8, 4, 4, 4, 12)), before + r.choice(["", "uuid ", "id "])
        elif kind == 3:
            v, before = "/".join(word() for _ in range(r.randint(3, 6))) + str(r.randint(0, 99)), before + r.choice(["/", "./", "~/", ""])
            after = r.choice([".py", ".js", ".html", "/ "]) + after
        elif kind == 4:
            v = "-".join([str(r.randint(1999, 2030)), f"{r.randint(1, 12):02d}", f"{r.randint(1, 28):02d}", *[word() for _ in range(r.randint(1, 4))]])
        elif kind == 5:
            v = word() + "".join(word().title() for _ in range(r.randint(2, 4))) + str(r.randint(0, 99))
        elif kind == 6:
            v = "_".join(word() for _ in range(r.randint(3, 5))) + r.choice(["1", "2", "_v2", "_2024"])
        elif kind == 7:
            named = True
            v, before = r.choice(["YOUR_PASSWORD_HERE", "changeme123456", "xxxxxxxxxxxxxxxx", "example_token_value", "placeholder-secret-1", "your-api-key-here", "000000000000", "test_password_123"]), before + r.choice(SECRET_NAMES.split()) + r.choice(["=", ": "])
        elif kind == 8:
            v = chars(num, r.choice([12, 13, 15, 16, 16, 16, 19]))
        elif kind == 9:
            v = chars(num, 8) + "T" + chars(num, 6) + "Z"
        elif kind == 10:
            named = True
            v = r.choice(["${" + word().upper() + "}", "%s", "null", "None", "os.environ", "getenv", "required", "string", "config." + word(), "settings." + word(), "request." + word(), "self." + word(), word(), "********", "true", "<" + word() + ">", "process.env." + word().upper()])
            v, before = (v + "_value")[: max(6, len(v))].strip("<>{}"), before + prefix() + r.choice(SECRET_NAMES.split()) + r.choice(["=", ": ", " = "])
        else:
            v, before = "-".join(chars(num, 4) for _ in range(4)), before + r.choice(["order ", "card ", "serial ", ""])
        return v, before, after, named, r.choice(["src0", "tests/test_app.py", "docs/example.md", "package.lock", "src/main.js"]), 0.0

    return [secret() if i % 2 else plain() for i in range(rows)]


def _table(findings: DataFrame, words: Lexicon, *others: Column) -> DataFrame:
    cols = [F.col(c) for c in ("v", "named", "before", "after", "path", "dictionary")]
    return covered(findings, words).select(*others, *[c.alias(f"f_{n}") for n, c in zip(FEATURES, features(*cols, words), strict=True)])


def fit(spark: SparkSession, words: Lexicon, findings: DataFrame | None = None):
    """The forest.  findings: v, before, after, named, path, label (1.0: a secret); bounded by the caller."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    if findings is None:
        findings = spark.createDataFrame(labelled(words.words), "v string, before string, after string, named boolean, path string, label double").coalesce(1)
    rows = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(_table(findings, words, F.col("label")))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8, featureSubsetStrategy="sqrt").fit(rows.select("features", "label"))


def _rows(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """row, k, start, end (code points), v, named, before, after, path: a row for each candidate of every document, and
    one with v null for a document without.  row numbers the rows of docs; written, so that it stays the same.

    One scan marks the matches, and the text is split at the marks; places are running sums of the lengths, and the context is taken from the
    matches and pieces beside, so that nothing is looked for, or copied, from the text's start.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    path = F.coalesce(named(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    found = docs.select(F.monotonically_increasing_id().alias("row"), named(id_col).cast("long").alias("k"), path.alias("path"), F.split(F.regexp_replace(F.translate(text, _MARK, _FOR_MARK), f"({_CANDIDATE})", f"{_MARK}$1{_MARK}"), _MARK, -1).alias("x"))
    # pieces and matches in turn
    found = found.select("row", "k", "path", F.filter("x", lambda s, i: i % 2 == 1).alias("m"), F.filter("x", lambda s, i: i % 2 == 0).alias("p"))
    some = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))

    def parts(both: Column) -> Column:
        m, p = both["m"], both["p"]

        def one(x: Column, i: Column) -> Column:
            before = F.concat(F.right(some(p, i - 2), F.lit(BEFORE)), some(m, i - 2), F.right(some(p, i - 1), F.lit(BEFORE)), some(m, i - 1), F.right(some(p, i), F.lit(BEFORE)))
            after = F.concat(F.left(some(p, i + 1), F.lit(AFTER)), some(m, i + 1), F.left(some(p, i + 2), F.lit(AFTER)))
            return F.struct(i.alias("i"), x.alias("m"), (F.length(F.get(p, i)) + F.length(x)).alias("n"), before.alias("before"), F.left(after, F.lit(AFTER)).alias("after"))

        return F.transform(m, one)

    cut = found.select("row", "k", "path", F.explode_outer(let(F.struct("m", "p"), parts)).alias("c")).select("row", "k", "path", "c.*")
    end = F.sum("n").over(Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    v = F.when(F.col("m").rlike(rf"^{_ASSIGNED}{_VALUE}$"), F.regexp_extract("m", rf"^{_ASSIGNED}({_VALUE})$", 1))
    out = cut.withColumn("end", end.cast("int")).withColumn("named", v.isNotNull()).withColumn("v", F.coalesce(v, "m")).withColumn("start", F.col("end") - F.length("v"))
    head = F.substr("m", F.lit(1), F.length("m") - F.length("v"))
    out = out.withColumn("before", F.right(F.concat("before", head), F.lit(BEFORE)))
    wanted = F.col("named") | F.col("v").rlike("[0-9]")
    return staged(out.select("row", "k", "start", "end", F.when(wanted, F.col("v")).alias("v"), "named", "before", "after", "path"), "secrets-candidates")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """k, start, end (code points), v, named, before, after, path: one row for each candidate of every document.

    before: up to 40 characters, no further back than the second candidate before; after: up to 12.
    """
    return _rows(docs, id_col, text_col, path_col).where("v IS NOT NULL").drop("row")


def _scored(rows: DataFrame, model, words: Lexicon, threshold: float) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    found = rows.where("v IS NOT NULL").withColumnRenamed("row", "doc")
    table = _table(found, words, *[F.col(c) for c in ("doc", "k", "start", "end", "v", "named")])
    table = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(table)
    p = vector_to_array(F.col("probability"))[1]
    return model.transform(table).select("doc", "k", "start", "end", "v", "named", p.alias("probability")).withColumn("secret", F.col("probability") >= threshold)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", model=None, words: Lexicon | None = None, threshold: float = 0.5) -> DataFrame:
    """id_col, start, end, v, named, probability, secret: one row for each candidate.

    words: the corpus's lexicon (default: of docs); model: from fit() with the same.  Null and empty texts have no
    candidates; a null path is empty; a null id comes back null; rows that repeat an id give their candidates each; other
    columns are not read.  No rows: no rows.
    """
    words = words or lexicon(docs, text_col)
    model = model or fit(docs.sparkSession, words)
    return _scored(_rows(docs, id_col, text_col, path_col), model, words, threshold).drop("doc").withColumnRenamed("k", id_col)


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", model=None, words: Lexicon | None = None, threshold: float = 0.5) -> DataFrame:
    """id_col, n_candidates, n_secrets, spans (start:end of secrets, by start, comma-joined), one row for each row of docs.

    As scan(); a row's spans are together, and rows that repeat an id, or have none, are each their own.
    """
    words = words or lexicon(docs, text_col)
    model = model or fit(docs.sparkSession, words)
    rows = _rows(docs, id_col, text_col, path_col)
    found = _scored(rows, model, words, threshold)
    mine = F.when(F.col("secret"), F.struct("start", "end"))
    counted = found.groupBy(F.col("doc").alias("row")).agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if("secret").alias("n_secrets"), F.array_sort(F.collect_list(mine)).alias("s"))
    spans = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    none = F.lit(0).cast("long")
    out = rows.select("row", "k").distinct().join(counted, "row", "left")
    return out.select(F.col("k").alias(id_col), F.coalesce("n_candidates", none).alias("n_candidates"), F.coalesce("n_secrets", none).alias("n_secrets"), F.coalesce(spans, F.lit("")).alias("spans"))
