"""Secret scans: native candidate search, random forest against false positives.

One regular expression proposes candidates in the whole text: values assigned
to a secret-like name (anywhere in the dotted or dashed name), tokens with a vendor prefix,
private-key blocks and any long run of token characters that holds a digit.  It runs once
per text, in time linear in the text: no part of it walks a name again from a later start.
A random forest trained on labelled findings then decides; its features are the candidate's
length, character transitions (class changes, repeats, vowels after consonants, longest
stretch of small letters), dictionary coverage, path shape and the neighbouring words.

The dictionary is learned from the corpus: words of small letters that ``MIN_DOCS`` or more rows
hold, counted over the whole table.  A value is cut at case changes, digits and separators, and its
coverage is the share of its characters in known words, by a join of the distinct values' pieces with the
words (neither side is sent to the driver).

The main path is DataFrame functions and Spark ML only.  Candidates carry their neighbourhood,
not the text.  ``labelled_findings`` gives findings with known answers (secrets
of random characters against hashes in paths, numbers, placeholders, and identifiers and paths
made of up to ``SAMPLE_WORDS`` words of the corpus); callers may pass their own table of the same
columns.  Training hides a third of the words from the dictionary, so that the forest also
meets identifiers of unknown words.

``redact`` masks by position: the accepted candidates of a text, and every other candidate of that text with
the same value.  The same characters outside a candidate stay.

Defined cases: a null or empty text has no findings; equal rows report each;
one value found at several places of a text is reported once per place; a null
``doc_id`` is kept as null; an empty table gives an empty result; without a word in ``MIN_DOCS``
rows the coverage is 0 and identifiers are made of fixed syllables.  Other
columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

CUT = 0.5
LABELLED = 6000
TREES = 24
DEPTH = 8
CONTEXT = 40
#: Rows that must hold a word before it is in the dictionary, and words that made-up identifiers are drawn from.
MIN_DOCS = 3
SAMPLE_WORDS = 400
#: Secret-like names, vendor prefixes and ordinary names that precede values.
NAMES = ["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "credential", "private_key"]
PREFIXES = ["AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "sk-", "sk_live_", "rk_live_", "AIza", "glpat-", "npm_", "eyJ"]
PLAIN = ["commit", "sha", "sha1", "sha256", "md5", "id", "uuid", "isbn", "card", "phone", "order", "version", "build", "page", "file", "path", "url", "src", "href", "checksum"]
SAMPLES = ["example", "changeme", "placeholder", "your_", "xxxx", "test", "dummy", "sample", "redacted", "0000", "1234"]
PARTS = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "ch", "ie", "ge", "un"]
_VALUE = r"[A-Za-z0-9_\-+/=.~!@#$%^&*]"
_WORD = r"[A-Za-z0-9_\-.]"
_SAYS = r"[\"']?[ \t]{0,4}"
#: A whole dotted name with a secret-like name in it, and its assignment; the first look drops words that nothing is assigned to.
_NAMED = r"(?=" + _WORD + r"++" + _SAYS + r"[=:])(?=" + _WORD + r"*?(?i:" + "|".join(NAMES) + r"))" + _WORD + r"++" + _SAYS + r"(?::=|=>|[=:])[ \t]{0,4}[\"']?"
_RUN = r"[A-Za-z0-9_+/=\-]"
_VENDOR = r"(?:" + "|".join(PREFIXES) + r")"
#: Where another candidate begins inside a run of token characters: an assignment to a (prefixed) name, or a
#: vendor prefix with its token after "/" or "=".
_NEXT = r"(?:[+/=]" + _NAMED + _VALUE + r"{6}|[/=]" + _VENDOR + _RUN + r"{16})"
#: 16 or more token characters, up to the next candidate; none if that one begins sooner.
_TOKEN = r"(?:" + _RUN + r"{16,}?(?=" + _NEXT + r")|(?!" + _RUN + r"{0,15}?" + _NEXT + r")" + _RUN + r"{16,})"
CANDIDATE = (
    r"(?:(?<![A-Za-z0-9_\-.])|\G)(?!" + _VENDOR + r"[A-Za-z0-9]{16})" + _NAMED + _VALUE + r"{6,}"
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"
    r"|(?<![A-Za-z0-9])" + _VENDOR + _TOKEN +
    r"|(?<![A-Za-z0-9_+/=\-])(?=[A-Za-z_+/=\-]*[0-9])" + _TOKEN
)
_ASSIGNED = r"^" + _NAMED
FEATURES = ["length", "digits", "uppers", "lowers", "others", "changes", "repeats", "pairs", "coverage", "slashes", "dots", "dashes",
            "prefix", "named", "plain", "sample", "quoted", "only_digits", "only_hex", "key_block", "distinct", "longest"]
#: Pieces of one prefix sum.
_BLOCK = 256


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value evaluated once a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _pieces(text: Column) -> Column:
    """The text cut around its candidates (gap, candidate, gap, ...); null without one.

    The cuts are marked with the text's own digest, which the text does not hold.
    """
    mark = F.concat(F.lit("\x01"), F.sha2(text.cast("binary"), 256), F.lit("\x01"))
    whole = F.struct(mark.alias("mark"), F.regexp_replace(text, F.lit(CANDIDATE), F.concat(mark, F.lit("$0"), mark)).alias("all"))
    return _let(whole, lambda w: F.when(w["all"] != text, F.split(w["all"], w["mark"], -1)))


def _placed(held: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep..., i, start, found, before, after)`` of the candidates of ``held(keep..., __pieces)``, numbered from 0."""

    def hits(cut: Column, lengths: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
        sums = F.transform(blocks, lambda k: F.aggregate(F.slice(lengths, k * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, x: a + x))
        heads = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])

        def hit(head: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            inside = F.aggregate(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK), F.lit(0), lambda a, x: a + x)
            return F.struct(F.floor(i / 2).cast("int").alias("i"), (F.get(head, block) + inside + 1).alias("start"), F.get(cut, i).alias("found"),
                            F.right(F.get(cut, i - 1), F.lit(CONTEXT)).alias("before"), F.substring(F.get(cut, i + 1), 1, CONTEXT).alias("after"))

        return _let(heads, lambda head: F.transform(F.sequence(F.lit(1), F.size(cut) - 2, F.lit(2)), lambda i: hit(head, i)))

    cut = F.col("__pieces")
    found = _let(F.transform(cut, lambda x: F.length(x)), lambda lengths: hits(cut, lengths))
    return held.where(cut.isNotNull()).select(*keep, F.explode(found).alias("__hit")).select(*keep, "__hit.*")


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep..., i, start, found, before, after)`` of every place that the expression matches; 1-based ``start``."""
    return _placed(stored(docs.select(*keep, _pieces(F.col("text")).alias("__pieces")), "secret-pieces"), keep)


def word_table(docs: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """``(word)``: words of three or more small letters that ``least`` or more rows of ``docs(text)`` hold."""
    rows = docs.select(F.explode(F.array_distinct(F.split("text", "[^A-Za-z0-9_]+"))).alias("word")).where(F.col("word").rlike("^[a-z]{3,}$"))
    return stored(rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word"), "secret-words")


def _covered(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``(__value, __covered)``: characters in known words, per digest of a distinct value that has some."""
    key = F.sha2(F.col("value").cast("binary"), 256)
    values = rows.select(key.alias("__value"), "value").dropDuplicates(["__value"])
    parts = values.select("__value", F.explode(F.regexp_extract_all("value", F.lit(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])"), F.lit(0))).alias("part"))
    known = parts.select("__value", F.lower("part").alias("word")).join(words, "word")
    return stored(known.groupBy("__value").agg(F.sum(F.length("word")).alias("__covered")), "secret-coverage")


def value_of(found: Column) -> Column:
    """The candidate without the name and quote it is assigned to."""
    return F.regexp_replace(found, _ASSIGNED, "")


def with_features(rows: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Adds ``value`` and the vector ``x`` to ``rows(found, before, after)``; ``words(word)`` is the dictionary, without it fixed syllables are."""
    rows = rows.withColumn("value", value_of(F.col("found")))
    if words is None:
        covered = F.length("value") - F.length(F.regexp_replace(F.lower("value"), "(?:" + "|".join(PARTS) + ")", ""))
        return _featured(rows.withColumn("__covered", covered)).drop("__covered")
    rows = stored(rows, "secret-candidates")
    known = _covered(rows, words).withColumnRenamed("__value", "__known")
    joined = rows.join(known, F.sha2(F.col("value").cast("binary"), 256) == F.col("__known"), "left")
    return _featured(joined).drop("__covered", "__known")


def _featured(rows: DataFrame) -> DataFrame:
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)) / n

    lead = F.lower(F.coalesce("before", F.lit("")))
    named = lead.rlike(r"(?:" + "|".join(NAMES) + r")[a-z0-9_]*[\"']?\s*(?::=|=>|[=:])\s*[\"']?[^\s]*$")
    named = named | F.col("found").rlike(_ASSIGNED) | F.col("found").rlike("[+/=]" + _NAMED)
    flags = {
        "prefix": v.rlike("^(?:" + "|".join(PREFIXES) + ")"),
        "named": named,
        "plain": F.lower(F.coalesce("before", F.lit(""))).rlike(r"(?:^|[^a-z])(?:" + "|".join(PLAIN) + r")[\"']?\s*[=: /#]?\s*[\"']?$"),
        "sample": F.lower(v).rlike("|".join(SAMPLES)),
        "quoted": F.coalesce(F.col("before").rlike("[\"']$"), F.lit(False)) | F.col("found").rlike(_ASSIGNED + "(?<=[\"'])"),
        "only_digits": v.rlike(r"^[0-9\-]+$"),
        "only_hex": v.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$"),
        "key_block": v.rlike("PRIVATE KEY"),
    }
    numbers = {
        "length": F.least(n, F.lit(200)) / 200,
        "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"), "others": share("[^A-Za-z0-9]"),
        "changes": share("[0-9](?=[A-Za-z])|[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])"), "repeats": share(r"(.)(?=\1)"),
        "pairs": share("[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z](?=[aeiouAEIOU])"), "coverage": F.col("__covered") / n,
        "slashes": share("/"), "dots": share("[.]"), "dashes": share("[-_]"),
        "distinct": F.size(F.array_distinct(F.split(F.substring(v, 1, 64), ""))) / F.least(n, F.lit(64)),
        "longest": F.least(F.array_max(F.transform(F.split(v, "[^a-z]+"), lambda x: F.length(x))), F.lit(40)) / 40,
    }
    cells = [F.coalesce((numbers[f] if f in numbers else flags[f].cast("int")).cast("double"), F.lit(0.0)) for f in FEATURES]
    return rows.withColumn("x", array_to_vector(F.array(*cells)))


def labelled_findings(spark: SparkSession, n: int = LABELLED, seed: int = 8, words: DataFrame | None = None) -> DataFrame:
    """``(found, before, after, label)``: ``n`` findings of known kind, made from hashes of the row number.

    Identifiers and paths are made of the ``SAMPLE_WORDS`` words of ``words`` with the smallest MD5.
    """
    drawn = [] if words is None else [r.word for r in words.orderBy(F.md5(F.col("word").cast("binary")), "word").limit(SAMPLE_WORDS).collect()]
    told = F.from_json(F.lit(json.dumps(drawn)), "array<string>")
    i = F.col("id")

    def draw(k: int) -> Column:
        return F.md5(F.concat_ws("-", i.cast("string"), F.lit(f"{seed}-{k}")).cast("binary"))

    def pick(values: list[str], k: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.conv(F.substring(draw(k), 1, 6), 16, 10).cast("long"), F.lit(len(values))) + 1).cast("int"))

    mixed = F.regexp_replace(F.base64(F.concat(F.unhex(draw(1)), F.unhex(draw(2)))), "[=+/]", "q")
    upper = F.upper(F.regexp_replace(mixed, "[189]", "7"))
    hexed = F.concat(draw(3), draw(4))
    digits = F.regexp_replace(F.translate(hexed, "abcdef", "314159"), "[^0-9]", "")
    word = F.concat(*[pick(PARTS, k) for k in range(20, 28)])

    def term(k: int) -> Column:
        if not drawn:
            return F.concat(pick(PARTS, k), pick(PARTS, k + 100), pick(PARTS, k + 200))
        return F.element_at(told, (F.pmod(F.conv(F.substring(draw(k), 1, 6), 16, 10).cast("long"), F.lit(len(drawn))) + 1).cast("int"))

    camel = F.concat(term(51), *[F.initcap(term(k)) for k in (52, 53, 54)], pick(["", "", "Request", "Service"], 55))
    number = F.left(digits, F.pmod(F.conv(F.substring(draw(56), 1, 4), 16, 10).cast("long"), F.lit(4)).cast("int"))
    joint = pick(["_", "-"], 57)
    snake = F.concat(term(58), joint, term(59), joint, term(60), joint, term(61), F.left(digits, F.lit(1)))
    name = [F.when(draw(k + 20).substr(1, 1) < "8", F.left(term(k), F.lit(4))).otherwise(term(k)) for k in (63, 64, 65, 66)]
    last = F.when(draw(87).substr(1, 1) < "8", F.upper(name[3])).otherwise(F.initcap(name[3]))
    folders = F.concat(pick(["/", "", "../"], 62), F.concat_ws("/", name[0], name[1], pick(PARTS, 67), F.concat(name[2], F.left(digits, F.lit(1))), last), number)
    size = (F.pmod(F.conv(F.substring(draw(9), 1, 6), 16, 10).cast("long"), F.lit(24)) + 16).cast("int")
    tail = F.concat(F.lit(" "), pick(PARTS, 40), pick(PARTS, 41))
    head = F.concat(pick(PARTS, 42), pick(PARTS, 43), F.lit(" "), pick(PARTS, 44), pick(PARTS, 45), F.lit(" "))
    sep = pick(["=", " = ", ": ", "=\"", " = \"", ": '"], 5)
    said = F.concat(pick(NAMES, 6), sep)
    uuid = F.concat_ws("-", F.substring(hexed, 1, 8), F.substring(hexed, 9, 4), F.substring(hexed, 13, 4), F.substring(hexed, 17, 4), F.substring(hexed, 21, 12))
    kinds = [  # (label, found, what stands right before it)
        (1, F.concat(said, F.substring(hexed, 1, 18)), F.lit("")),
        (1, F.concat(said, F.substring(hexed, 1, 40)), F.lit("")),
        (1, F.concat(said, F.left(mixed, size)), F.lit("")),
        (1, F.concat(pick(["AKIA", "ASIA"], 7), F.left(upper, F.lit(16))), F.lit("")),
        (1, F.concat(pick(PREFIXES, 8), F.left(mixed, F.lit(36))), F.lit("")),
        (1, F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), mixed, F.lit("\n-----END RSA PRIVATE KEY-----")), F.lit("")),
        (0, F.left(digits, F.lit(16)), F.lit("")),
        (0, F.left(hexed, F.lit(40)), F.concat(pick(PLAIN, 10), pick([" ", ": ", "=", "/"], 11))),
        (0, uuid, pick(["", "id=", "uuid: ", "order "], 12)),
        (0, F.concat(word, F.left(digits, F.lit(3)), pick(PARTS, 46)), F.lit("")),
        (0, F.concat(F.lit("static/"), word, F.lit("/"), F.left(hexed, F.lit(8)), F.lit("/"), pick(PARTS, 47)), pick(["src=", "href=\"/", "https://", ""], 13)),
        (0, F.concat(said, pick(["your_password_here", "changeme123", "xxxxxxxxxxxxxxxx", "example-token-1234", "placeholder", "test1234test", "dummy_secret_0"], 14)), F.lit("")),
        (0, F.concat(said, word), F.lit("")),
        (0, F.concat(F.lit("20"), F.left(digits, F.lit(2)), F.lit("-10-"), F.substring(digits, 3, 2), F.lit("-"), word), F.lit("")),
        (0, F.concat(camel, F.left(digits, F.lit(1)), number), F.lit("")),
        (0, F.concat(said, camel), F.lit("")),
        (0, snake, F.lit("")),
        (0, folders, F.lit("")),
        (0, F.concat(pick(PARTS, 48), F.lit("="), F.left(digits, F.lit(18))), pick(PLAIN, 15)),
    ]
    which = F.pmod(i, F.lit(len(kinds)))
    case = lambda at: F.element_at(F.array(*[k[at] for k in kinds]), (which + 1).cast("int"))
    rows = spark.range(n)
    return rows.select(case(1).alias("found"), F.right(F.concat(head, case(2)), F.lit(CONTEXT)).alias("before"), tail.alias("after"),
                       F.element_at(F.array(*[F.lit(float(k[0])) for k in kinds]), (which + 1).cast("int")).alias("label"))


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 8, words: DataFrame | None = None) -> RandomForestClassificationModel:
    if words is not None:  # a third of the words is unknown in training
        words = words.where(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(3)) != 0)
    rows = stored(with_features(labelled, words).select("x", "label"), "secret-labels")
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows)


def _scored(rows: DataFrame, words: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``rows`` of candidates with ``value`` and ``score``."""
    model = model or fit(labelled_findings(rows.sparkSession, words=words), words=words)
    return model.transform(with_features(rows, words)).withColumn("score", vector_to_array("probability")[1])


def findings(docs: DataFrame, keep: list[str] | None = None, model: RandomForestClassificationModel | None = None, cut: float = CUT,
             words: DataFrame | None = None) -> DataFrame:
    """``(keep..., start, found, value, score)`` of the candidates that the forest takes for secrets.

    ``words`` is the dictionary; without it, the one of ``docs``.
    """
    keep = keep or ["doc_id"]
    rows = _scored(candidates(docs, keep), word_table(docs) if words is None else words, model).where(F.col("score") >= cut)
    return rows.select(*keep, "start", "found", "value", "score")


def redact(docs: DataFrame, mark: str = "[SECRET]", cut: float = CUT) -> DataFrame:
    """``docs`` with every found value replaced by ``mark`` at its place (and ``n_chars`` counted anew where it exists).

    Documents without a candidate pass through; only those with one are joined
    with their findings.
    """
    tagged = stored(docs.withColumn("__pieces", _pieces(F.col("text"))), "secret-texts")
    held = tagged.where(F.col("__pieces").isNotNull()).withColumn("__key", F.sha2(F.col("text").cast("binary"), 256))
    rows = _placed(held.dropDuplicates(["__key"]).select("__key", "__pieces"), ["__key"])
    scored = _scored(rows, word_table(docs), None)
    # one verdict per value of a text, then the verdicts of a text in the order of its candidates
    places = scored.select("__key", "i", "score", F.sha2(F.col("value").cast("binary"), 256).alias("v"), (F.length("found") - F.length("value")).alias("lead"))
    judged = places.groupBy("__key", "v").agg(F.max("score").alias("best"), F.collect_list(F.struct("i", "lead")).alias("at"))
    judged = judged.select("__key", F.col("best").alias("best"), F.explode("at").alias("at"))
    judged = judged.select("__key", F.struct(F.col("at.i").alias("i"), F.when(F.col("best") >= cut, F.col("at.lead")).alias("lead")).alias("at"))
    judged = judged.groupBy("__key").agg(F.sort_array(F.collect_list("at")).alias("__at"), F.max(F.col("at.lead").isNotNull()).alias("__some")).where("__some")
    judged = stored(judged.drop("__some"), "secret-places")  # both sides of the join are plain shuffles then, and AQE splits a text with many copies

    def masked(piece: Column, i: Column) -> Column:
        lead = F.get("__at", F.floor(i / 2).cast("int"))["lead"]
        return F.when((i % 2 == 1) & lead.isNotNull(), F.concat(F.left(piece, lead), F.lit(mark))).otherwise(piece)

    clean = F.array_join(F.transform("__pieces", masked), "")
    changed = F.col("__at").isNotNull()
    done = held.join(judged, "__key", "left").withColumn("text", F.when(changed, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return tagged.where(F.col("__pieces").isNull()).select(*docs.columns).unionByName(done.select(*docs.columns))


def op8_secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per finding: place, length and digest of the value (the value itself stays out of the report)."""
    rows = findings(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("start").cast("long").alias("start"), F.length("found").cast("long").alias("found_chars"),
                       F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"))
