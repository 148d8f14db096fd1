"""Secret scans: assigned values and long tokens, judged by a random forest on what they and their surroundings look like.

A candidate is a value of any length and characters assigned to a word that announces a secret, or
a run of at least ``MIN_LENGTH`` letters, digits, ``+ / _ -`` with a digit, in a word of the text.
Features: its length, shares of character classes, class changes between neighbouring characters,
coverage by dictionary words, the path it was found under, and the words before and after it. The forest is trained from labelled findings, to tell real secrets from hashes,
numbers, identifiers and placeholders, and then written out as one Column expression, so that
scanning and masking stay inside each row: no join, no shuffle, no Python.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import xxhash
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.common import let
from quotemill.llm.quality import words_of

MIN_LENGTH = 16
MASK = "[SECRET]"
TREES, DEPTH, SEED = 20, 6, 11
#: Labelled findings made by rule, for want of a table of real ones: so many of each kind.
PER_KIND = 60

#: Dictionary words whose share of a candidate counts as coverage.
DICTIONARY = (
    "about access account address admin answer article author backup build change changeme class client cloud code commit config content count "
    "country create data date default deploy dev document domain download dummy email error event example fake field file filter first follow "
    "format found function general get group guide header hello here home host html http https image index info input insert item json key lang "
    "language last level library license line link list local login long main manager master message method model module name network new node "
    "number object online open order output package page part password path placeholder point policy post price primary print private process "
    "product profile program project public query random read record release remote report request response result sample search second secret "
    "section security select server service session set short sign site small sort source spec staging start state status store string style "
    "submit support system table target template test text the theme this time title token tool topic tree type update upload user username "
    "utils value version video view web window work world write your zone"
).split()

#: Words that passphrases are made of in the labelled findings; one by itself is taken for prose.
UNCOMMON = (
    "horse battery staple correct dragon monkey hunter falcon marble copper velvet thunder pepper orchid saddle winter tiger rocket harbor cactus "
    "lantern walnut ginger breeze meadow pirate anchor violet summer coffee turtle rabbit silver panther troubador pumpkin galaxy shadow wizard castle"
).split()

FEATURES = ("length", "digits", "upper", "lower", "other", "symbols", "changes", "hex", "only_digits", "coverage", "known_prefix", "assigned", "near_secret", "near_hash", "near_contact", "hash_after", "contact_after", "path_test")

#: Words that announce a secret, a digest, or contact and number data; paths of examples and tests; prefixes of known key formats.
NEAR_SECRET = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key|client[_-]?secret)"
NEAR_HASH = r"(?i)(commit|sha-?\d*|md5|checksum|digest|hash|etag|revision|uuid|guid|build|version|blob|tree)"
NEAR_CONTACT = r"(?i)(phone|tel|fax|card|account|iban|isbn|order|invoice|customer|number|id|http|www)"
PATH_TEST = r"(?i)(test|example|sample|fixture|mock|demo|docs?)([/_.-]|$)"
KNOWN_PREFIX = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{30,}|sk_(live|test)_[0-9A-Za-z]{16,}|xox[abprs]-[0-9A-Za-z-]{16,}|AIza[0-9A-Za-z_-]{30,}|glpat-[0-9A-Za-z_-]{16,})"

_RUN = rf"([A-Za-z0-9+/_-]{{{MIN_LENGTH},}})"
#: A secret-announcing word and what assigns to it, at the end of what precedes a value; and a value in the same word.
_ASSIGN = NEAR_SECRET + r"s?\d*[\"'\])]*\s?[:=]{1,2}>?\s?[\"'(<]*"
_ASSIGNED = rf"{_ASSIGN}$|(?i)bearer\s?$"
_INSIDE = rf"{_ASSIGN}(?=[^\s\"'(<:=>])"
#: Quotes and brackets around a value, and what ends a clause after it.
_OPENING, _CLOSING = r"^[\"'(<]+", r"[\"',;)>\]]*[.,;]?$"


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def features(value: Column, left: Column, right: Column, path: Column) -> list[Column]:
    """In the order of FEATURES, all doubles."""
    covered = F.length(value) - F.length(F.regexp_replace(F.lower(value), "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")", ""))
    flag = lambda c: c.cast("double")
    columns = (
        F.length(value).cast("double"),
        _share(value, "[0-9]"),
        _share(value, "[A-Z]"),
        _share(value, "[a-z]"),
        _share(value, "[+/_-]"),
        _share(value, "[^A-Za-z0-9+/_-]"),
        F.regexp_count(value, F.lit(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]")) / F.length(value),
        flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        flag(value.rlike("^[0-9+/_-]+$")),
        covered / F.length(value),
        flag(value.rlike(KNOWN_PREFIX)),
        flag(left.rlike("[=:]\\s*[\"'(<]?$")),
        flag(left.rlike(NEAR_SECRET)),
        flag(left.rlike(NEAR_HASH)),
        flag(left.rlike(NEAR_CONTACT)),
        flag(right.rlike(NEAR_HASH)),
        flag(right.rlike(NEAR_CONTACT)),
        flag(path.rlike(PATH_TEST)),
    )
    return [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns]


def candidates(text: Column) -> Column:
    """array<struct<value, left, right>>: each candidate, the two words before it with what precedes it in its own, and the two words after.

    An assigned value comes before the runs inside it, and a run that is the whole of it doesn't come again.
    """
    none = F.lit(None).cast("string")

    def found(words: Column) -> Column:
        before = lambda i: F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1))
        after = lambda i: F.concat_ws(" ", F.get(words, i + 1), F.get(words, i + 2))
        opens = lambda w: w.rlike("[:=]>?[\"'(<]*$") | w.rlike("(?i)bearer$")
        assigned = lambda w, i: (  # noqa: E731  what is assigned by, or in, the word
            F.when(w.rlike("[:=].") & w.rlike(_INSIDE), F.regexp_replace(w, rf"^.*?{_INSIDE}", ""))
            .when(F.coalesce(opens(F.get(words, i - 1)), F.lit(False)) & before(i).rlike(_ASSIGNED) & w.rlike("[A-Za-z0-9]"), F.regexp_replace(w, _OPENING, ""))
            .otherwise(none)
        )
        value = lambda w, i: F.nullif(F.regexp_replace(assigned(w, i), _CLOSING, ""), F.lit(""))
        at = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"), value(w, i).alias("v")))
        at = F.filter(at, lambda x: x["v"].isNotNull() | (F.length(x["w"]) >= MIN_LENGTH) & x["w"].rlike("[0-9]") & x["w"].rlike(_RUN))

        def each(x: Column) -> Column:
            runs = F.filter(F.regexp_extract_all(x["w"], F.lit(_RUN), F.lit(1)), lambda v: v.rlike("[0-9]") & ~v.eqNullSafe(x["v"]))
            values = F.concat(F.filter(F.array(x["v"]), lambda v: v.isNotNull()), runs)
            return F.transform(values, lambda v: F.struct(v.alias("value"), F.concat_ws(" ", before(x["i"]), F.call_function("substring_index", x["w"], v, F.lit(1))).alias("left"), after(x["i"]).alias("right")))

        return F.flatten(F.transform(at, each))

    kind = "array<struct<value:string,left:string,right:string>>"
    return F.when(may_hold(text), let(words_of(text), found)).otherwise(F.array().cast(kind))


def may_hold(text: Column) -> Column:
    """Whether a text can have a candidate at all: something assigns, or there is a digit and a long run. Few texts do, and only those are cut in words."""
    assigns = F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")) | text.rlike("(?i)bearer")
    return F.coalesce(assigns | text.rlike("[0-9]") & text.rlike(_RUN), F.lit(False))


def _hash(*parts: str | tuple[int, int]) -> int:
    """Spark's xxhash64 of texts and of integers of so many bytes."""
    seed = 42
    for x in parts:
        seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else x[0].to_bytes(x[1], "little"), seed)
    return seed - (seed >> 63 << 64)


def labelled_findings(spark: SparkSession, per_kind: int = PER_KIND) -> DataFrame:
    """kind, value, left, right, path, label: findings made by rule, the same every time. 1: a secret; 0: a false positive."""
    rows = [(kind, *_findings(k)[kind]) for kind in range(len(_findings(0))) for k in range(per_kind)]
    return spark.createDataFrame(rows, "kind int, value string, left string, right string, path string, label int")


@lru_cache(maxsize=256)
def _findings(number: int) -> list[tuple[str, str, str, str, int]]:
    """The finding of each kind with this number."""
    md5 = lambda tag: hashlib.md5(f"{tag}{number}".encode()).hexdigest()
    rnd = lambda tag, n: (md5(tag) + md5(f"{tag}+") + md5(f"{tag}-"))[:n]
    swap = lambda text, a, b: text.translate(str.maketrans(a, b))
    b32 = lambda tag, n: swap(rnd(tag, n), "0123456789abcdef", "QW3RTYUI7PASDF5H")
    b64 = lambda tag, n: "".join(swap(rnd(f"{tag}{k}", n // 4), "0123456789abcdef", alphabet) for k, alphabet in enumerate(("aQ3xW9zLmK0PvJ5t", "Bn7cRy2HsD8fGe4U", "iO1oTpZqX6AjwYk-", "lMrEhSb_CgNdVuI3")))
    digits = lambda tag, n: swap(rnd(tag, n), "abcdef", "314159")
    words = lambda tag, n: "_".join(DICTIONARY[_hash(tag, (number, 8), (k, 4)) % len(DICTIONARY)] for k in range(n))
    one = lambda tag, xs: xs[_hash(tag, (number, 8)) % len(xs)]
    phrase = lambda tag, sep: sep.join(one(f"{tag}{k}", UNCOMMON) for k in range(4))
    leet = lambda tag: swap(one(tag, UNCOMMON).capitalize(), "aeiost", "@31057")
    mixed_case = lambda tag, n: swap(rnd(tag, n), "0123456789abcdef", "aQxWzLmKPvJtRyHe")  # noqa: E731  no digits
    plain = ("the value was", "see also", "und die", "de la", "of that", "")
    secret = ("password=", "api_key =", "token = \"", "secret:", "client_secret = '", "Authorization: Bearer", "access_key =", "pwd:")
    hashes = ("commit", "sha256:", "md5 checksum", "etag =", "uuid", "revision", "digest:", "build")
    contact = ("card number", "phone:", "order id", "call", "account", "pay with", "de", "que")
    after, after_hash = ("the", "und die", "", "que did", "in order", "de la", "number of"), ("was merged", "is the checksum", "commit", "matches sha256", "build log")
    files = ("src/app.py", "conf/settings.yml", "web", "notes.txt")
    tests = ("tests/data.py", "docs/example.md", "samples/demo.txt", "fixtures/a.json")
    kinds = [
        ("AKIA" + b32("a", 16), plain + secret, files, 1),
        (rnd("t", 40), secret, files, 1),
        (rnd("p", 18), secret, files, 1),
        (rnd("q", 32), secret, files, 1),
        (b64("u", 24), secret, files, 1),
        (b64("v", 40), secret, files, 1),
        ("ghp_" + b64("g", 36), plain + secret, files, 1),
        ("sk_live_" + swap(b64("s", 24), "_-", "xy"), plain + secret, files, 1),
        (f"xoxb-{digits('x', 12)}-{b64('y', 24)}", plain + secret, files, 1),
        (leet("A") + digits("B", 2), secret, files, 1),
        (f"{one('C', UNCOMMON)}{digits('D', 1)}-{digits('E', 4)}", secret, files, 1),
        (one("F", UNCOMMON).capitalize() + one("G", ("!", "@", "#", "$", "&")) + digits("H", 4), secret, files, 1),
        (phrase("I", "_"), secret, files, 1),
        (phrase("J", "-"), secret, files, 1),
        (phrase("K", "."), secret, files, 1),
        (b64("L", 8) + one("M", (".", "=", "!", "@", "&", "~")) + b64("N", 8), secret, files, 1),
        (b64("O", 8), secret, files, 1),
        (b64("P", 12), secret, files, 1),
        (mixed_case("Q", 12), secret, files, 1),
        (mixed_case("R", 24), secret, files, 1),
        (rnd("S", 6) + one("T", ("!", "~", ".", "&")) + mixed_case("U", 5), secret, files, 1),
        (one("V", DICTIONARY), secret, files, 0),
        (one("W", UNCOMMON), secret, files, 0),
        (one("X", ("null", "None", "true", "false", "required", "optional", "string", "xxxxxxxx", "********", "...", "str", "the", "der", "que", "les", "REDACTED", "changeme", "undefined")), secret, files, 0),
        (words("Y", 2), secret, files, 0),
        (swap(words("Z", 2), "_", "."), secret, files, 0),
        (swap(words("ab", 3), "_", "-"), secret, files, 0),
        ("${" + words("ac", 2).upper() + "}", secret, files, 0),
        ("{{" + words("ad", 1) + "}}", secret, files, 0),
        (words("ae", 2) + "()", secret, files, 0),
        ("os.environ['" + words("af", 2).upper(), secret, files, 0),
        (digits("ag", 3), secret, files, 0),
        (f"https://{words('ah', 1)}.{words('ai', 1)}.com/", secret, files, 0),
        (rnd("c", 40), hashes + plain, files, 0),
        (rnd("m", 32), hashes + plain, files, 0),
        ("-".join((rnd("d", 8), rnd("e", 4), rnd("f", 4), rnd("h", 4), rnd("i", 12))), hashes + plain + contact, files, 0),
        (digits("n", 16), contact + plain, files, 0),
        (digits("o", 20), contact + plain, files, 0),
        ("-".join(digits(tag, 4) for tag in "jklr"), contact + plain, files, 0),
        (words("w", 3) + "_" + digits("z", 2), plain + secret, files, 0),
        (f"/{swap(words('b', 3), '_', '/')}/{digits('0', 3)}", plain + contact, files, 0),
        (f"your_{words('1', 2)}_here_{digits('2', 3)}", secret, files, 0),
        (f"AKIAEXAMPLE{b32('3', 2)}1EXAMPLE", secret, tests, 0),
        (rnd("4", 40), secret, tests, 0),
        (rnd("5", 18), secret, tests, 0),
        (digits("6", 16), secret[3:5], tests, 0),
    ]
    pick = lambda xs, salt: xs[_hash((number, 8), (salt, 4)) % len(xs)]
    return [(value, pick(lefts, 1), pick(after + (after_hash if lefts[: len(hashes)] == hashes else ()), 3), pick(paths, 2), label) for value, lefts, paths, label in kinds]


def training_rows(findings: DataFrame) -> DataFrame:
    """label and the features as one vector; findings are few, so their features are computed once and kept as rows of the plan."""
    rows = findings.select(F.col("label").cast("double").alias("label"), F.array(*features(F.col("value"), F.col("left"), F.col("right"), F.col("path"))).alias("features")).collect()
    return findings.sparkSession.createDataFrame([(r["label"], Vectors.dense(r["features"])) for r in rows], ["label", "features"]).coalesce(1)


def trained(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt").fit(training_rows(findings))


def forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> str:
    """The trained forest's trees in Spark's own printed form, without the name that Spark makes up."""
    return trained(findings, trees, depth).toDebugString.split("\n", 1)[1]


_KNOWN: dict[str, str] = {}


def known_forest(spark: SparkSession) -> str:
    """The forest of the findings made by rule, trained once in an application."""
    app = spark.sparkContext.applicationId
    if app not in _KNOWN:
        _KNOWN[app] = forest(labelled_findings(spark))
    return _KNOWN[app]


def _tree(lines: list[str], at: int, field) -> tuple[Column, int]:
    """The Column of the tree that begins at a line, and the line after it."""
    if m := re.match(r"Predict: (\S+)", lines[at]):
        return F.lit(float(m[1])), at + 1
    name, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
    yes, at = _tree(lines, at + 1, field)
    no, at = _tree(lines, at + 1, field)  # steps over "Else (...)"
    return F.when(field(int(name)) <= float(bound), yes).otherwise(no), at


def forest_score(printed: str, field) -> Column:
    """The share of trees that vote for a secret; field(k) is the Column of feature k."""
    lines = [x.strip() for x in printed.splitlines()]
    roots = [k + 1 for k, x in enumerate(lines) if x.startswith("Tree ")]
    votes = [_tree(lines, k, field)[0] for k in roots]
    total = votes[0]
    for v in votes[1:]:
        total = total + v
    return total / len(votes)


def findings_of(text: Column, path: Column, printed: str) -> Column:
    """array<struct<value, score>> for a text's candidates."""

    def scored(c: Column) -> Column:
        row = F.struct(c["value"].alias("value"), *[f.alias(n) for n, f in zip(FEATURES, features(c["value"], c["left"], c["right"], path), strict=True)])
        return let(row, lambda x: F.struct(x["value"].alias("value"), forest_score(printed, lambda k: x[FEATURES[k]]).alias("score")))

    return F.transform(candidates(F.coalesce(text, F.lit(""))), scored)


def secret_findings(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """A row for each candidate: doc_id, finding (from 0, in the order of the text), start, value, score, is_secret.

    start: characters before the value; of a value that is found several times, before its first,
    second and further occurrence. A null text has no candidates, a null path counts as empty.
    Repeated rows give their findings each time; other columns aren't looked at, whatever their
    names; an empty table gives an empty result.
    """
    printed = known_forest(docs.sparkSession) if findings is None else forest(findings)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"))
    before = lambda f, k, fs: F.size(F.filter(F.slice(fs, F.lit(1), k), lambda x: x["value"] == f["value"])) + 1
    placed = lambda fs: F.transform(fs, lambda f, k: F.struct(f["value"].alias("value"), f["score"].alias("score"), before(f, k, fs).alias("nth")))
    rows = rows.select("doc_id", "text", F.posexplode(let(findings_of(F.col("text"), F.col("path"), printed), placed)).alias("finding", "f"))
    start = F.length(F.call_function("substring_index", F.col("text"), F.col("f.value"), F.col("f.nth")))
    return rows.select("doc_id", "finding", start.cast("long").alias("start"), F.col("f.value").alias("value"), F.col("f.score").alias("score"), (F.col("f.score") >= 0.5).alias("is_secret"))


def mask_secrets(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path_col: str = "source") -> DataFrame:
    """docs with every value found to be a secret replaced by MASK, wherever it stands in its text; null texts stay null."""
    printed = known_forest(docs.sparkSession) if findings is None else forest(findings)
    found = F.filter(findings_of(F.col(text_col), F.coalesce(F.col(path_col).cast("string"), F.lit("")), printed), lambda x: x["score"] >= 0.5)
    # a short value isn't masked inside of longer words
    quoted = lambda v: F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.call_function("replace", v, F.lit("\\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])"))
    mask = lambda text, x: F.when(F.length(x["value"]) >= MIN_LENGTH, F.call_function("replace", text, x["value"], F.lit(MASK))).otherwise(F.regexp_replace(text, quoted(x["value"]), F.lit(MASK)))
    return docs.withColumn(text_col, let(found, lambda xs: F.aggregate(xs, F.col(text_col), mask))).select(*docs.columns)


def secret_report(docs: DataFrame) -> DataFrame:
    """The findings with the MD5 of the value in its place."""
    df = secret_findings(docs.select("doc_id", "text", "source"))
    return df.select("doc_id", "finding", "start", F.length("value").alias("length"), F.md5("value").alias("value_md5"), "score", "is_secret")
