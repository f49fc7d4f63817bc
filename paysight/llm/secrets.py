"""Secret scan with a random forest for false-positive removal, in DataFrame operations only.

A regular expression finds candidates: whatever of six or more characters is assigned to a secret's name, what
follows such a name after blanks, what follows ``Bearer``, dotted web tokens, private key blocks, and runs of key
characters that hold a digit or stand right after ``=``, ``:`` or a quote. Each is described by its length, its character transitions, how much of it
dictionary words cover, the path of its document and the words around it. A forest trained on
labelled findings scores it. The fitted trees become one SQL expression over the candidate's
features, so scoring happens inside the row: texts are read once, and nothing is joined or shuffled.

Very long texts are searched whole: every repetition in the expression is possessive or bounded, so its
time grows with the text. A text is read once if it has no candidate, else twice; plain words are passed
over whole. Tied scores need no order, as each finding is decided by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_remainder, table

# A maximal run of eight or more key characters that holds a digit or follows an assignment or a quote.
CANDIDATE = r"""(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*+[0-9])|(?<=[=:"']))[A-Za-z0-9+/_-]{8,}"""
CONTEXT = 48  # characters kept on either side
LEAST = 6  # characters of the shortest candidate

# Words that name a secret, and words that mark an invented one.
KEY_WORDS = "password passwd pwd passphrase secret token credential api_key apikey access_key auth bearer private_key"
SHAM_WORDS = "example sample test dummy fake placeholder changeme xxxx"

# Common words and word parts; what they cover of a candidate looks like prose.
DICTIONARY = (
    "the and ing ion tion ent ment ness able ible ally ous ive ful less ship ward wise "
    "that this with from have were which their there would about other into more some time than then them these "
    "also made over such after first work year people through back where much before right mean same great world "
    "file name path home user data page line list item code main test index html http https www com org net "
    "version release license document report section table figure chapter number phone mail order invoice account "
    "example sample test dummy fake placeholder changeme xxxx "
    "der die und das ist nicht ein eine von mit auf fur des den les une pour dans que est del los las con por para"
)

FEATURES = (
    "length", "digits", "upper", "lower", "transitions", "alternations", "distinct", "vowels", "hex_only", "digits_only",
    "dictionary", "path_sham", "path_depth", "left_key", "left_assign", "quoted", "left_sham", "next_to_at",
)

TREES = 16
DEPTH = 5
SEED = 42
GROUPS_A_TASK = 10_000  # distinct labelled findings in a partition of the forest's input, about
THRESHOLD = 0.5
MASK = "[secret]"


def _any_of(names: str) -> str:
    return "(?:" + "|".join(names.split()) + ")"


# A secret's name, to which a number or further parts may be joined, as in api_key_v2 or SECRET_KEY_1.
NAME = _any_of(KEY_WORDS) + r"(?:[_-]\w{1,40}|\d{1,4})?"
SIGN = r"""["']?\s{0,8}(?:[=:]{1,3}>?|=>)\s{0,8}"""  # after a name, before a value and its quote; a lookbehind needs a bound
KEYED = f"""{NAME}{SIGN}["']?$"""

# In any letter case, for lookbehinds, which try many places: the first letter spares most of them the words.
NAMED = f"(?i:(?=[{''.join(sorted({w[0] for w in KEY_WORDS.split()}))}]){NAME})"

# Six or more characters without a blank, assigned to a secret's name: up to the quote if there is one, else
# without punctuation at the end. The lookarounds ahead of the choice only spare those in it.
ASSIGNED = (
    r"""(?<=[=:>"'\s])(?![=:>])(?=[^\s"']{6})(?<=[=:]>?\s{0,8}["']?)(?!(?i:bearer|basic)\s)"""
    + f"""(?<={NAMED}{SIGN}["']?)"""
    + f"(?:(?<={NAMED}{SIGN}\")[^\\s\"]{{6,}}|(?<={NAMED}{SIGN}')[^\\s']{{6,}}"
    + f"|(?<={NAMED}{SIGN})[^\\s\"']{{5,}}[^\\s\"'.,;:!?)}}\\]>])"
)
# What follows a name after blanks alone must hold a digit; what follows "bearer" need not. The blank is asked
# for first: the search for a digit would run anew at each sign of a long row of signs.
SPACED = f"""(?<=\\s["']?)(?=[^\\s"']{{8}})(?=[^\\s"'0-9]*+[0-9])(?<={NAMED}\\s{{1,8}}["']?)[^\\s"']{{7,}}[^\\s"'.,;:!?)}}\\]>]"""
BEARER = r"(?<=\s)(?=[A-Za-z0-9._~+/=-]{8})(?<=(?i:bearer)\s{1,8})[A-Za-z0-9._~+/=-]{7,}[A-Za-z0-9_~+/=-]"
# A web token begins with the code of '{"'; a key block goes to its end line, or as far as its lines look like codes.
DOTTED = r"eyJ(?<![A-Za-z0-9+/_-]eyJ)[A-Za-z0-9_-]{5,}+(?:\.[A-Za-z0-9_-]++){1,4}"
KEY_LINE = r"(?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY(?: BLOCK)?-----"
KEY_BLOCK = rf"-----BEGIN {KEY_LINE}(?:\s{{1,4}}[A-Za-z0-9+/=]{{16,}}+)*+(?:(?:\s{{1,4}}[A-Za-z0-9+/=]++)?\s{{0,4}}-----END {KEY_LINE})?"
# the lookbehind is what all three have in common; it spares most positions all of them
SEARCH = f"(?:{KEY_BLOCK}|{DOTTED}|(?<=[=:>\"'\\s])(?:{ASSIGNED}|{BEARER}|{SPACED})|{CANDIDATE})"

# What holds no place where SEARCH matches, longer stretches first; each line passes over text that no alternative begins in.
KEY_CHARS = "A-Za-z0-9+/_-"
PASSED = (
    # blanks, not behind a sign or "bearer", words of letters alone that blanks end, each not "bearer", ...
    r"""(?<![=:>\s])(?<!(?i:bearer))\s++(?:[A-Z]*+[a-\uD7FF]*+(?<!(?i:bearer))[.,;!?)]*+\s++)*+"""
    # ... and the letters that begin what follows, if it is free of digits up to a blank or a quote
    r"""(?:(?!eyJ)(?![^\s"'0-9]*+[0-9])[A-Za-z+/_]++)?+""",
    # within a run of key characters; a dash could begin a key block
    f"(?<=[{KEY_CHARS}])[A-Za-z0-9+/_]++",
    r"""[\s"']++""",
    # behind other characters: a whole run of letters, what is no key character, a sign
    rf"""(?<![=:>"'\s])(?:(?!eyJ)[A-Za-z_]++(?![{KEY_CHARS}])|[^=:>"'\s{KEY_CHARS}]++|[=:>])""",
    # any other character, looked at closely
    rf"(?!{SEARCH})[\s\S]",
)
# The text up to the next candidate and the candidate, which is the first group, or the rest of the text.
NEXT = f"(?:{'|'.join(PASSED)})*+(?:({SEARCH})|\\z)"

# Formats of issued keys and tokens that leave no doubt.
ISSUED = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|eyJ[\w-]{5,}(?:\.[\w-]+){2,4}|-----BEGIN [\s\S]+)$"


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def describe(text: Column, left: Column, right: Column, path: Column) -> Column:
    """The features of one candidate as an array, in the order of FEATURES."""
    low, before = F.lower(text), F.lower(left)
    length = F.length(text)
    runs = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    uncovered = F.regexp_replace(low, _any_of(DICTIONARY), "")
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    values = [
        length,
        _share(text, "[0-9]"),
        _share(text, "[A-Z]"),
        _share(text, "[a-z]"),
        (F.length(runs) - 1) / length,
        _share(low, "(?:[a-z](?=[0-9])|[0-9](?=[a-z]))"),
        F.size(F.array_distinct(F.split(text, ""))) / length,
        _share(low, "[aeiou]"),
        flag(text.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        flag(text.rlike("^[0-9+/_-]+$")),
        1 - F.length(uncovered) / length,
        flag(F.lower(path).rlike(_any_of(SHAM_WORDS))),
        F.regexp_count(path, F.lit("/")),
        flag(before.rlike(NAME + r"\W{0,4}$") | before.rlike(KEYED)),
        flag(before.rlike(r"""[=:]>?\s{0,8}["']?$""")),
        flag(left.rlike("[\"']$") & right.rlike("^[\"']")),
        flag(before.rlike(r"\b" + _any_of(SHAM_WORDS))),
        flag(left.endswith("@") | right.startswith("@") | right.rlike(r"^\.\w+@")),
    ]
    return F.array(*[v.cast("double") for v in values])


def candidates(docs: DataFrame, text_col: str, path_col: str | None) -> DataFrame:
    """(doc, pieces, found): the row of ``docs`` as a struct, the text between its candidates, and of each start, text, left, right and features.

    Null and empty texts have one empty piece and nothing found. ``path_col`` may be missing.
    """
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit("")
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"),
        F.coalesce(path, F.lit("")).alias("path"),
    )
    # one match per candidate, then one for the rest of the text and perhaps an empty one at its end, both without a candidate
    out = out.withColumn("runs", F.array_remove(F.regexp_extract_all("body", F.lit(NEXT), F.lit(1)), ""))
    n = F.size("runs")
    out = out.withColumn("chunks", F.when(n > 0, F.regexp_extract_all("body", F.lit(NEXT), F.lit(0))))
    ahead = F.zip_with(F.slice("chunks", 1, n), "runs", lambda c, r: F.left(c, F.length(c) - F.length(r)))
    out = out.withColumn("pieces", F.when(n > 0, F.concat(ahead, F.slice("chunks", n + 1, 1))).otherwise(F.array("body"))).drop("chunks")
    # arrays are handed to the lambdas as arguments, worked out once per row, never looked up by index in them
    sizes = F.zip_with("pieces", "runs", lambda p, r: F.struct(F.length(p).alias("piece"), F.coalesce(F.length(r), F.lit(0)).alias("run")))
    step = lambda acc, s: F.struct(
        (acc["at"] + s["piece"] + s["run"]).alias("at"),
        F.concat(acc["starts"], F.array(acc["at"] + s["piece"])).alias("starts"),
    )
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("starts"))
    # the context is the whole text's, candidates included: pieces with their candidates, cut to what can be seen of
    # them, join with their neighbours, twice as many at each step, until the candidates alone fill the context
    first, last = (lambda text: F.left(text, F.lit(CONTEXT))), (lambda text: F.right(text, F.lit(CONTEXT)))
    whole = lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))
    out = out.withColumn("after", F.zip_with("pieces", "runs", lambda p, r: first(whole(p, r))))
    out = out.withColumn("before", F.zip_with("pieces", "runs", lambda p, r: last(whole(p, r))))
    span = 1
    while span * LEAST < CONTEXT:
        later = F.slice("after", span + 1, F.size("after"))
        earlier = F.slice(F.concat(F.array_repeat(F.lit(""), span), "before"), 1, F.size("before"))
        out = out.withColumns({
            "after": F.zip_with("after", later, lambda x, y: first(whole(x, y))),
            "before": F.zip_with(earlier, "before", lambda x, y: last(F.concat(x, y))),
        })
        span *= 2
    lefts = F.zip_with(F.slice(F.concat(F.array(F.lit("")), "before"), 1, n + 1), "pieces", lambda x, p: last(F.concat(x, p)))
    placed = F.arrays_zip(
        F.slice(F.aggregate(sizes, begin, step, lambda acc: acc["starts"]), 1, n).alias("start"),
        F.col("runs").alias("text"),
        F.slice(lefts, 1, n).alias("left"),
        F.slice("after", 2, n).alias("right"),
    )
    out = out.withColumn("found", placed)
    described = lambda c: c.withField("features", describe(c["text"], c["left"], c["right"], F.col("path")))
    return out.select("doc", "pieces", F.transform("found", described).alias("found"))


def rule_labels(found: Column) -> Column:
    """1, 0 or null for a finding: strict formats and contexts that leave no doubt teach the forest, the rest does not.

    1: a format of issued keys, a web token, a key block, or a value of 12 or more characters with letters and
    digits assigned to a secret's name. 0, which goes first: an invented value (it holds a word such as "example", such a
    word stands before it, or it has at most three different characters), only digits and separators, part of a mail
    address, or mostly covered by dictionary words without an assignment.
    """
    text, left, right = found["text"], F.lower(found["left"]), found["right"]
    keyed = left.rlike(KEYED)
    sham = text.rlike(f"(?i:{_any_of(SHAM_WORDS)})") | left.rlike(rf"\b{_any_of(SHAM_WORDS)}\b") | (F.size(F.array_distinct(F.split(text, ""))) <= 3)
    sure = text.rlike(ISSUED) | (keyed & text.rlike("[A-Za-z]") & text.rlike("[0-9]") & (F.length(text) >= 12))
    dictionary = F.get(found["features"], F.lit(FEATURES.index("dictionary")))
    harmless = text.rlike("^[0-9+/_-]+$") | left.endswith("@") | right.startswith("@") | ((dictionary >= 0.5) & ~keyed)
    return F.when(sham, 0).when(sure, 1).when(harmless, 0)


@dataclass
class SecretModel:
    """A forest: each tree a probability, or (feature, threshold, tree up to it, tree above it)."""

    trees: list

    def expression(self, features: str) -> str:
        """The mean of the trees as SQL over the array ``features``."""
        if not self.trees:
            return "0.0D"

        def sql(node) -> str:
            if isinstance(node, float):
                return f"{node!r}D"
            feature, threshold, low, high = node
            return f"IF({features}[{feature}] <= {threshold!r}D, {sql(low)}, {sql(high)})"

        return "(" + " + ".join(map(sql, self.trees)) + f") / {len(self.trees)}D"


def _tree(node):
    """A fitted Spark tree node as nested tuples."""
    if node.numDescendants() == 0:
        stats = list(node.impurityStats().stats())
        return float(stats[1] / sum(stats)) if len(stats) > 1 and sum(stats) else 0.0
    split = node.split()
    return (split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def fit_secrets(findings: DataFrame, scratch: Scratch | None = None) -> SecretModel:
    """A forest fitted on all labelled findings (features, label 0 or 1).

    Findings with equal features and label are one row with their number as its weight, so what repeats
    costs no more; they are written to ``scratch`` as the table ``findings``. Null labels teach nothing. Without both labels every score is the only label's value, or 0.
    """
    known = findings.filter(F.col("label").isin(0, 1)).groupBy("features", F.col("label").cast("double").alias("label")).agg(F.count("*").cast("double").alias("weight"))
    known = (scratch or Scratch(findings.sparkSession, "secrets")).write(known, "findings")
    groups, n, ones = known.agg(F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
    if not groups or ones in (0.0, n):
        return SecretModel([ones / n] if groups else [])
    # dealt by content into as many partitions as the rows ask for, each in one order: the forest follows from the rows
    parts = 1 + groups // GROUPS_A_TASK
    rows = known.select(array_to_vector("features").alias("x"), "label", "weight", "features").repartition(parts, "features", "label")
    rows = rows.sortWithinPartitions("label", "features").drop("features")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return SecretModel([_tree(tree._java_obj.rootNode()) for tree in forest.fit(rows).trees])


def _each(found: DataFrame, *columns: Column) -> DataFrame:
    """A row per candidate, as ``c``. An inner explode would let the optimizer test the array for being
    empty ahead of it, and so work out the whole array, its regular expressions included, twice."""
    return found.select(*columns, F.explode_outer("found").alias("c")).filter(F.col("c").isNotNull())


def held_out_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", folds: int = 5) -> DataFrame:
    """One row (n, true_positives, false_positives, false_negatives) over the labelled findings of one fold of documents by
    digest of the id, scored by a forest fitted on the other folds; all zero for an empty table."""
    labelled = _each(candidates(docs, text_col, path_col), (id_remainder(F.col("doc")[id_col], folds) == 0).alias("held"))
    labelled = labelled.select("held", F.col("c.features").alias("features"), rule_labels(F.col("c")).alias("label")).dropna(subset=["label"])
    scratch = Scratch(docs.sparkSession, "secrets")
    labelled = scratch.write(labelled, "labelled")
    model = fit_secrets(labelled.filter(~F.col("held")), scratch)
    scratch.drop("findings")
    says, is_one = F.expr(model.expression("features")) >= THRESHOLD, F.col("label") == 1
    return labelled.filter("held").agg(
        F.count("*").alias("n"), F.count_if(says & is_one).alias("true_positives"), F.count_if(says & ~is_one).alias("false_positives"), F.count_if(~says & is_one).alias("false_negatives")
    )


def learn_secrets(docs: DataFrame, text_col: str = "text", path_col: str | None = "source") -> SecretModel:
    """Fit on the findings of ``docs`` that the strict rules label."""
    used = [c for c in dict.fromkeys([text_col, path_col]) if c in docs.columns]
    found = _each(candidates(docs.select(*used), text_col, path_col))
    scratch = Scratch(docs.sparkSession, "secrets")
    model = fit_secrets(found.select(F.col("c.features").alias("features"), rule_labels(F.col("c")).alias("label")), scratch)
    scratch.drop("findings")  # the model is plain values; nothing reads the table any more
    return model


def scan_secrets(docs: DataFrame, model: SecretModel, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc, pieces, found) with a score for each candidate found."""
    score = model.expression("c.features")
    scored = F.expr(f"transform(found, c -> named_struct('start', c.start, 'text', c.text, 'left', c.left, 'right', c.right, 'features', c.features, 'score', {score}))")
    return candidates(docs, text_col, path_col).withColumn("found", scored)


def find_secrets(docs: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: id, start (character), text, left, right, score, is_secret.

    Documents without a candidate give no rows; repeated rows give theirs again. Null ids stay null.
    """
    used = [c for c in dict.fromkeys([id_col, text_col, path_col]) if c in docs.columns]
    found = scan_secrets(docs.select(*used), model, text_col, path_col)
    rows = _each(found, F.col("doc")[id_col].alias(id_col))
    return rows.select(id_col, "c.start", "c.text", "c.left", "c.right", "c.score", (F.col("c.score") >= THRESHOLD).alias("is_secret"))


def redact_secrets(
    docs: DataFrame, model: SecretModel, text_col: str = "text", path_col: str | None = "source", mask: str = MASK, length_col: str | None = None
) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; texts without one stay as they are, nulls too.

    ``length_col``, if given, gets the length of every text that was changed.
    """
    scanned = scan_secrets(docs, model, text_col, path_col)
    hidden = F.transform("found", lambda c: F.when(c["score"] >= THRESHOLD, F.lit(mask)).otherwise(c["text"]))
    pairs = F.arrays_zip(F.col("pieces").alias("piece"), F.concat(hidden, F.array(F.lit(""))).alias("run"))
    rebuilt = F.array_join(F.transform(pairs, lambda p: F.concat(p["piece"], p["run"])), "")
    scanned = scanned.withColumn("clean", F.when(F.exists("found", lambda c: c["score"] >= THRESHOLD), rebuilt))
    changed = {text_col: F.col("clean")}
    if length_col:
        changed[length_col] = F.length("clean").cast(docs.schema[length_col].dataType)
    old = lambda c: F.col("doc")[c]
    return scanned.select(*[(F.coalesce(changed[c], old(c)) if c in changed else old(c)).alias(c) for c in docs.columns])


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, learn_secrets(docs))
    end = F.col("start") + F.length("text")
    return found.select("doc_id", "start", end.alias("end"), F.sha2("text", 256).alias("text_sha256"), "score", "is_secret")
