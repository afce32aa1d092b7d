"""Secret scans: candidates by pattern, false positives removed by a random forest.

Built-in SQL functions and Spark's own random forest only.

* Candidates are runs of 16 or more letters, digits and ``+/_-`` that hold a digit, with the ``=``
  that pad their end, so that a value after ``=`` begins its own; and what is assigned to a secret
  word, of any length and with or without digits: up to a quote or space, and unquoted up to ``&,;``
  or a bracket.
* Features: length, character transitions and spread, the share of the candidate that dictionary
  words cover, path marks, and the words and signs beside it.
* The dictionary holds the words that all documents use most (a mergeable heavy-hitter summary of
  fixed size) and words of code and paths.
* The forest is trained on labelled findings, which are cut out of whole texts as candidates are.  ``labelled_findings`` makes a set from rules: keys,
  tokens and passwords against commit hashes, checksums, ids, paths, numbers and placeholders;
  ``scan`` takes any other with the same columns.

Defined results: one row per candidate, in reading order; ``start`` counts characters from 0; a
null or empty text has none; rows repeating an id are scanned each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CONTEXT_CHARS = 60
DICTIONARY_WORDS = 2_000
SKETCH_ITEMS = 65_536
LABELLED_ROWS = 6_000
TREES, DEPTH = 24, 7
THRESHOLD = 0.5

# Words beside a candidate; fixed values of the features.
SECRET_WORDS = ("secret|token|passw|pwd|credential|auth|bearer|private|access.?key|api.?key|apikey"
                "|signature|session")
PLAIN_WORDS = ("commit|sha-?1|sha-?256|md5|hash|checksum|digest|uuid|guid|version|revision|build|order"
               "|invoice|isbn|phone|card|page|figure|chapter|http|www|file|path|example|sample")
SIGNS = "A-Za-z0-9+/_-"
_QUOTES = "\"'`"
_RUN = (f"(?<![{SIGNS}])(?=[A-Za-z+/_-]*+[0-9])[{SIGNS}]{{16,}}+"
        f"(?:={{1,2}}(?![={SIGNS}]))?")
# Cheap conditions first: a sign of assignment just before, then the word that it belongs to.
_ASSIGN = f"[{_QUOTES}]?\\s{{0,3}}[=:]>?\\s{{0,3}}"
_WORD = f"(?i:{SECRET_WORDS})[A-Za-z0-9_.-]{{0,30}}{_ASSIGN}"
_OPEN = f"\\s&,;<>(){{}}\\[\\]{_QUOTES}"
_QUOTED = (f"(?<=[{_QUOTES}])(?<=[=:]>?\\s{{0,3}}[{_QUOTES}])(?<={_WORD}[{_QUOTES}])"
           f"[^\\s{_QUOTES}]++(?=[{_QUOTES}])")
_BARE = (f"(?<=[=:>\\s])(?![=:>\\s])(?<=[=:]>?\\s{{0,3}})(?<={_WORD})"
         f"(?!(?i:bearer|basic)\\s)[^{_OPEN}]*[^{_OPEN}.:?]")
CANDIDATE = f"{_QUOTED}|{_BARE}|{_RUN}"
# Words of code and paths, which texts seldom hold.
CODE_WORDS = (
    "home user usr local share config settings main test tests java python include source build"
    " target dist node modules assets images static index public project package class function"
    " file data json html http https example sample placeholder your here insert value changeme"
    " chapter part section long book report version release draft final").split()

_FEATURES = [
    "length", "transitions", "case_changes", "distinct", "entropy", "digits", "vowels", "hex_only",
    "upper", "dictionary", "slashes", "dashes", "repeats", "secret_before", "plain_before", "assigned",
    "quoted", "slash_before", "sign_after", "address_after"]


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def with_features(findings: DataFrame, dictionary: list[str]) -> DataFrame:
    """Adds ``features`` to ``candidate, before, after``."""
    c, before = F.col("candidate"), F.lower("before")
    near = F.regexp_extract(
        before, f"([^\\s/?&,;]*\\s*[^\\s/?&,;]*?)(?:{_ASSIGN}[{_QUOTES}]?)?$", 1)
    chars = F.array_distinct(F.split(c, ""))
    share = lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / F.length(c)
    words = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0)))
    known = F.array_intersect(words, F.array(*[F.lit(w) for w in dictionary]))
    covered = F.aggregate(known, F.lit(0.0), lambda s, w: s + F.length(w))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    columns = {
        "length": F.log2(F.length(c)),
        "transitions": _share(c, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_changes": _share(c, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "distinct": F.size(chars) / F.least(F.length(c), F.lit(64)),
        "entropy": F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0.0),
                               lambda s, x: s - share(x) * F.log2(share(x))),
        "digits": _share(c, "[0-9]"),
        "vowels": _share(c, "[aeiouAEIOU]"),
        "hex_only": flag(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "upper": _share(c, "[A-Z]"),
        "dictionary": covered / F.length(c),
        "slashes": F.regexp_count(c, F.lit("/")).cast("double"),
        "dashes": F.regexp_count(c, F.lit("[-_]")).cast("double"),
        "repeats": _share(c, "(.)(?=\\1)"),
        "secret_before": flag(near.rlike(SECRET_WORDS)),
        "plain_before": flag(near.rlike(PLAIN_WORDS)),
        "assigned": flag(before.rlike("[=:]\\s*[\"'`]?$")),
        "quoted": flag(before.rlike("[\"'`]$")),
        "slash_before": flag(before.rlike("[/.\\\\]$")),
        "sign_after": flag(F.col("after").rlike("^[.:@][A-Za-z0-9]")),
        "address_after": flag(F.col("after").rlike("^[A-Za-z0-9.]*@")),
    }
    return findings.withColumn("features", array_to_vector(F.array(
        *[F.coalesce(columns[name].cast("double"), F.lit(0.0)) for name in _FEATURES])))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, start, candidate, before, after`` of every candidate.

    The pieces between candidates give the places: a running sum over the few rows of a text.  Beside
    a candidate are such pieces and, where they are short, its neighbours, as in ``name=value``.
    """
    text, pattern = F.col(f"`{text_col}`"), F.lit(CANDIDATE)
    found = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
                    F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"), text.alias("text"))
        .where(F.size("found") > 0)
        .withColumn("gaps", F.split("text", CANDIDATE, -1)))
    at = F.col("at")
    piece = lambda name, i: F.coalesce(F.get(name, i), F.lit(""))
    rows = found.select("id", "row", "gaps", "found", F.posexplode("found").alias("at", "candidate")).select(
        "id", "row", "at", "candidate", F.length(F.get("gaps", at)).alias("gap"),
        F.right(F.concat(piece("gaps", at - 1), piece("found", at - 1), piece("gaps", at)),
                F.lit(CONTEXT_CHARS)).alias("before"),
        F.substring(F.concat(piece("gaps", at + 1), piece("found", at + 1), piece("gaps", at + 2)),
                    1, CONTEXT_CHARS).alias("after"))
    so_far = Window.partitionBy("row").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(
        "start", F.sum(F.col("gap") + F.length("candidate")).over(so_far) - F.length("candidate")
    ).select("id", "start", "candidate", "before", "after")


def dictionary_of(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The most used words of four letters or more, from all documents, and words of code."""
    words = docs.select(F.explode(F.regexp_extract_all(
        F.lower(F.col(f"`{text_col}`")), F.lit("(?<![a-z])[a-z]{4,20}(?![a-z])"), F.lit(0))).alias("word"))
    top = words.agg(F.expr(f"approx_top_k(word, {DICTIONARY_WORDS}, {SKETCH_ITEMS})").alias("top"))
    return sorted({r["item"] for r in top.select(F.inline("top")).collect()} | set(CODE_WORDS))


def labelled_findings(spark: SparkSession) -> DataFrame:
    """``candidate, before, after, label``: the candidates of LABELLED_ROWS texts made from rules."""
    rows = spark.range(LABELLED_ROWS).selectExpr(
        "id", "sha1(concat('s', id)) AS h", "sha2(concat('t', id), 256) AS h2",
        "regexp_replace(base64(unhex(sha2(concat('u', id), 256))), '=', '') AS b",
        "translate(substr(sha1(concat('w', id)), 1, 9), '0123456789', 'eaiounrstl') AS w",
        "xxhash64(id, 7) AS r")
    secret = "element_at(array('token', 'secret', 'password', 'api_key', 'auth_token', 'access key'), 1 + cast(pmod(r, 6) AS int))"
    plain = "element_at(array('commit', 'checksum', 'sha256', 'build', 'md5', 'revision'), 1 + cast(pmod(r, 6) AS int))"
    sign = "element_at(array(' = \"', '=', ': ', ': \"', ' '), 1 + cast(pmod(shiftright(r, 8), 5) AS int))"
    size = "16 + cast(pmod(shiftright(r, 16), 24) AS int)"
    path = "element_at(array('src/main/', 'usr/local/', 'assets/images/', 'home/user/'), 1 + cast(pmod(r, 4) AS int))"
    assign = "element_at(array(' = \"', '=', ': ', ': \"', '\":\"'), 1 + cast(pmod(shiftright(r, 8), 5) AS int))"
    after = "element_at(array('\" ', ' ', ' ', '\" ', '\",'), 1 + cast(pmod(shiftright(r, 8), 5) AS int))"
    mark = "element_at(array('&', '!', '#', '%', '', '-'), 1 + cast(pmod(shiftright(r, 20), 6) AS int))"
    mark = f"IF({assign} LIKE '%\"', {mark}, replace({mark}, '&', '$'))"
    join = "element_at(array('-', '_', '.', '/'), 1 + cast(pmod(shiftright(r, 40), 4) AS int))"
    of = ", ".join(f"'{w}'" for w in sorted({w for w in CODE_WORDS if len(w) > 3}))
    word = lambda bit: (
        f"element_at(array({of}), 1 + cast(pmod(xxhash64(shiftright(r, {bit})), size(array({of}))) AS int))")
    cases = [  # before, value, after, label
        (f"concat(w, ' ', {secret}, {sign})", "h", "'\" '", 1),
        (f"concat(w, ' ', {secret}, {sign})", f"substr(b, 1, {size})", "'\"'", 1),
        (f"concat(w, ' ', {secret}, {sign})", f"substr(h2, 1, {size})", "'\"'", 1),
        (f"concat(w, ' ', upper({secret}), {sign})", "upper(h)", "'\"!!'", 1),
        ("concat(w, ' Authorization: Bearer ')", "b", "' '", 1),
        ("concat(w, ' aws ')", "concat('AKIA', upper(substr(h, 1, 16)))", "' '", 1),
        (f"concat(w, ' ', {sign})", "concat('ghp_', substr(b, 1, 36))", "' '", 1),
        (f"concat(w, ' ', {secret}, {sign})", "concat('sk-', substr(b, 1, 32))", "'\"'", 1),
        (f"concat(w, ' ', {plain}, ' ')", "h", "' '", 0),
        (f"concat(w, ' ', {plain}, ': ')", f"substr(h2, 1, {size} * 2)", "' '", 0),
        ("concat(w, ' id ')", "concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12))", "' '", 0),
        ("concat(w, ' /')", f"concat({path}, w, '/index_', r % 100, '_test')", "'.html'", 0),
        ("concat(w, ' number ')", "substr(concat('4', abs(r), abs(r)), 1, 16 + pmod(id, 5))", "' '", 0),
        ("concat(w, ' https://example.com/')", "concat('chapter-', r % 100, '-long-book-report-', w)", "' '", 0),
        (f"concat(w, ' ', {secret}, {sign})", "element_at(array('your-api-key-here-123', 'xxxxxxxxxxxxxxxxxxxx1', '0000000000000000', 'changeme-placeholder-1', '1234567890123456'), 1 + cast(pmod(r, 5) AS int))", "'\"'", 0),
        ("concat(w, ' ')", "concat(w, w, r % 10)", "element_at(array(' ', '@mail.example.com', '.'), 1 + cast(pmod(r, 3) AS int))", 0),
        (f"concat(w, ' ', {secret}, {assign})", f"concat(initcap(substr(w, 1, 4)), abs(r % 90), {mark}, substr(b, 1, 3 + cast(pmod(r, 5) AS int)))", f"{after}", 1),
        (f"concat(w, ' db_', {secret}, {assign})", "substr(translate(b, '0123456789+/', 'abcdefghijkl'), 1, 8 + cast(pmod(r, 16) AS int))", f"{after}", 1),
        (f"concat(w, ' ', {secret}, {assign})", f"concat({word(0)}, {word(8)}, {word(16)}, {word(24)})", f"{after}", 1),
        (f"concat(w, ' ', {secret}, {assign})", f"concat({word(0)}, abs(r % 98), {mark})", f"{after}", 1),
        (f"concat(w, ' ', {secret}, {assign})", f"concat(substr(w, 1, 6), abs(r % 98), {mark})", f"{after}", 1),
        (f"concat(w, ' ', {secret}, {assign})", f"{word(0)}", f"{after}", 0),
        (f"concat(w, ' ', {secret}, {assign})", "substr('1234567890123456789012345678901234567890', 1 + cast(pmod(r, 10) AS int), 8 + cast(pmod(shiftright(r, 24), 16) AS int))", f"{after}", 0),
        (f"concat(w, ' the ', {secret}, ': ')", f"{word(0)}", f"concat(' ', {word(8)}, ' ', {word(16)})", 0),
        (f"concat(w, ' ', {secret}, {assign})", f"concat({word(0)}, {join}, {word(8)})", f"{after}", 0),
    ]
    pick = lambda k: f"CASE id % {len(cases)} " + " ".join(
        f"WHEN {i} THEN {case[k]}" for i, case in enumerate(cases)) + " END"
    texts = rows.selectExpr("id", f"{pick(0)} AS head", f"{pick(1)} AS value", f"{pick(2)} AS tail",
                            f"cast({pick(3)} AS double) AS label").withColumn(
        "text", F.concat("head", "value", "tail"))
    # A candidate is labelled by the value that it overlaps; one order, so that a seed gives one forest.
    begin = F.length("head")
    return (
        candidates(texts, "id").join(texts.select("id", "head", "value", "label"), "id")
        .where((F.col("start") < begin + F.length("value"))
               & (F.col("start") + F.length("candidate") > begin))
        .repartition(1).sortWithinPartitions("id", "start")
        .select("candidate", "before", "after", "label"))


def fit(labelled: DataFrame, dictionary: list[str]) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=5)
    return forest.fit(with_features(labelled, dictionary).select("features", "label"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per candidate: id, ``start, n_chars, candidate, score, is_secret``."""
    dictionary = dictionary_of(docs, text_col)
    labelled = labelled_findings(docs.sparkSession) if labelled is None else labelled
    model = fit(labelled, dictionary)
    scored = model.transform(with_features(candidates(docs, id_col, text_col), dictionary))
    score = vector_to_array("probability")[1]
    return scored.select(
        F.col("id").alias(id_col), "start", F.length("candidate").alias("n_chars"), "candidate",
        F.round(score, 9).alias("score"), (score >= THRESHOLD).alias("is_secret"))
