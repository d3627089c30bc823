"""Personal data by fixed rules and by contexts learned from what they find.

Base rules find e-mail addresses, network addresses, card and phone numbers. They are
the seeds of a bootstrap: tokens that look like identifiers are instances, the two words
before and the two words after one, whatever they are, are its lexical patterns, with
every digit as 0. A pattern is in use once enough different accepted instances stand in
it; seeds are accepted from the start. Its confidence is the summed score of its
instances by all places of the corpus where its words stand, whatever follows, so a
common pair of words is no evidence; an instance's score is the chance that one of its
patterns in use holds, and it is accepted at a least score. An accepted instance brings
its other patterns into use, so the graph of patterns and instances is gone over until
no instance is accepted any more. Scores only rise, so this ends. Tokens of accepted
instances in confident patterns become spans of kind id.

DataFrame functions only. A regular expression gives its matches and the pieces between
them, whose lengths give every span; spans, not texts, are shuffled. A pattern of many
instances is a key of sums, which are formed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.sources.workspace import staged

# The base rules. Quantifiers that cannot give back are possessive, which
# changes no match and keeps long runs linear; a run is entered at its first character
# or where the match before it ended.
LOCAL = "A-Za-z0-9._%+-"
RULES = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without such a place has no match of the rule.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
KINDS = (*RULES, "id")
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: An identifier-like token: a run between blanks with an @ or with four digits.
TOKEN = r"(?<!\S)(?=[^\s@]*+@|(?:[^\s0-9]*+[0-9]){4})\S++"
#: Characters of a text kept on either side of a token; words are taken from them.
CONTEXT = 512

#: Different accepted instances a pattern needs, and the confidence and score that make
#: a span.
LEAST_SEEDS = 4
CONFIDENT = 0.6
ACCEPTED = 0.6
#: Patterns are first counted in one of this many parts of the corpus, to rule out most.
PART_OF = 16
#: Most patterns that are broadcast to count where their words stand.
MOST_BROADCAST = 1 << 20


def _scanned(kind: str) -> list[Column]:
    """Matches of one rule and the pieces between them, always one more."""
    rule = F.lit(TOKEN if kind == "id" else RULES[kind])
    scan = F.lit(True) if kind == "id" else F.col("text").rlike(NEEDS[kind])
    none = F.array().cast("array<string>")
    return [
        F.when(scan, F.regexp_extract_all("text", rule, F.lit(0))).otherwise(none).alias(f"match_{kind}"),
        F.when(scan, F.split("text", TOKEN if kind == "id" else RULES[kind], -1)).otherwise(none).alias(f"gap_{kind}"),
    ]


def _pieces(kind: str) -> str:
    """SQL: array of (kind, index, match, gap, left, right) of one rule's matches.

    Matches and pieces are columns of the projection below, which stays apart because
    pieces are used twice; so a text is scanned once per rule.
    """
    gap, match = f"gap_{kind}", f"match_{kind}"
    left = right = "''"
    if kind == "id":
        # A token is one word, so two of them beside this one are context enough.
        before = ", ".join(f"coalesce(get({gap}, i - {k}), ''), coalesce(get({match}, i - {k}), '')" for k in (2, 1))
        after = ", ".join(f"coalesce(get({match}, i + {k}), ''), coalesce(get({gap}, i + {k + 1}), '')" for k in (1, 2))
        left = f"right(concat({before}, {gap}[i]), {CONTEXT})"
        right = f"left(concat({gap}[i + 1], {after}), {CONTEXT})"
    return (
        f"transform({match}, (m, i) -> struct({KINDS.index(kind)} AS kind, i AS index, m AS match,"
        f" CAST(char_length({gap}[i]) AS BIGINT) AS gap, {left} AS left, {right} AS right))"
    )


def _holds(kind: Column, match: Column) -> Column:
    """Whether a match of a base rule is valid."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    many = F.char_length(digits)
    digit = "CAST(substring(digits, i, 1) AS INT)"
    luhn = F.expr(
        "aggregate(sequence(1, char_length(digits)), 0, (a, i) -> a + IF((char_length(digits) - i) % 2 = 0,"
        f" {digit}, IF({digit} > 4, 2 * {digit} - 9, 2 * {digit}))) % 10 = 0"
    )
    return (
        F.when(kind == 0, True)
        .when(kind == 1, match.rlike(rf"^{PART}(?:\.{PART}){{3}}$"))
        .when(kind == 2, F.when(many.between(14, 19), luhn).otherwise(False))
        .when(kind == 3, many.between(10, 15))
        .otherwise(False)
    )


def _found(docs: DataFrame) -> DataFrame:
    """One row per match with its span, and one of kind -1 per row of ``docs``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    blank = "array(struct(-1 AS kind, 0 AS index, '' AS match, 0L AS gap, '' AS left, '' AS right))"
    every = ", ".join([blank, *map(_pieces, KINDS)])
    scanned = rows.select("row", "doc_id", *[column for kind in KINDS for column in _scanned(kind)])
    matches = scanned.select("row", "doc_id", F.explode(F.expr(f"concat({every})")).alias("m"))
    matches = matches.select("row", "doc_id", "m.*")
    order = Window.partitionBy("row", "kind").orderBy("index")
    until = F.sum(F.col("gap") + F.char_length("match")).over(order)
    spans = matches.withColumn("end", until).withColumn("start", F.col("end") - F.char_length("match"))
    spans = spans.withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    spans = spans.withColumn("valid", _holds(F.col("kind"), F.col("match"))).drop("digits", "gap", "index")
    # A token is a seed where a valid base span lies over it.
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    base_end = F.max(F.when(F.col("valid"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    base_start = F.min(F.when(F.col("valid"), F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    over = (F.coalesce(base_end, F.lit(-1)) > F.col("start")) | (F.coalesce(base_start, F.col("end")) < F.col("end"))
    return spans.withColumn("seed", over)


def _plain(text: str) -> str:
    """SQL: lower case, every digit as 0."""
    return f"translate(lower({text}), '123456789', '000000000')"


def _pattern(side: str, words: str) -> str:
    return f"xxhash64('{side}', {words}[0], {words}[1])"


def _patterns(tokens: DataFrame) -> DataFrame:
    """row, start, end, instance, seed and pattern of every token, one row per pattern."""
    before = f"regexp_extract({_plain('left')}, r'(\\S+\\s+\\S+)\\s+$', 1)"
    after = f"regexp_extract({_plain('right')}, r'^\\s+(\\S+\\s+\\S+)', 1)"
    pairs = tokens.select(
        "row", "start", "end", "seed", F.xxhash64(F.lower("match")).alias("instance"),
        F.expr(f"split({before}, r'\\s+')").alias("before"), F.expr(f"split({after}, r'\\s+')").alias("after"),
    )
    both = F.expr(
        f"filter(array(IF(size(before) = 2, {_pattern('before', 'before')}, NULL),"
        f" IF(size(after) = 2, {_pattern('after', 'after')}, NULL)), p -> p IS NOT NULL)"
    )
    return pairs.select("row", "start", "end", "seed", "instance", F.explode(both).alias("pattern"))


def _places(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, places: how often a pattern's two words stand in the corpus."""
    words = docs.where("text is not null").select(
        F.split(F.expr(_plain("CAST(text AS STRING)")), r"\s+").alias("words")
    )
    pairs = (
        "CASE WHEN size(words) >= 2 THEN transform(sequence(0, size(words) - 2), i -> array("
        "xxhash64('before', words[i], words[i + 1]), xxhash64('after', words[i], words[i + 1]))) ELSE array() END"
    )
    every = words.select(F.explode(F.expr(pairs)).alias("two")).select(F.explode("two").alias("pattern"))
    few = patterns.count() <= MOST_BROADCAST
    met = every.join(F.broadcast(patterns) if few else patterns, "pattern", "left_semi")
    return met.groupBy("pattern").agg(F.count("*").alias("places"))


def _confidences(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """pattern, confidence of the patterns in use, by the scores of their instances."""
    return (
        edges.join(scores, "instance")
        .groupBy("pattern")
        .agg(
            F.count_if(F.col("score") >= ACCEPTED).alias("accepted"),
            (F.sum(F.col("score") * F.col("times")) / F.max("places")).alias("confidence"),
        )
        .where(F.col("accepted") >= LEAST_SEEDS)
        .select("pattern", F.least("confidence", F.lit(0.999)).alias("confidence"))
    )


def _scores(edges: DataFrame, confidence: DataFrame) -> DataFrame:
    """instance, score: 1 for a seed, else the chance that a pattern in use holds."""
    return (
        edges.join(confidence, "pattern", "left")
        .groupBy("instance")
        .agg(
            F.max("seed").alias("seed"),
            (1 - F.exp(F.sum(F.log(1 - F.coalesce("confidence", F.lit(0.0)))))).alias("held"),
        )
        .select("instance", F.when(F.col("seed"), 1.0).otherwise(F.col("held")).alias("score"))
    )


def discover(docs: DataFrame, found: DataFrame) -> DataFrame:
    """row, start, end of tokens outside base spans that confident patterns hold."""
    graph = staged(_patterns(found.where(F.col("kind") == KINDS.index("id"))), "graph")
    counted = graph.groupBy("pattern").agg(
        F.countDistinct("instance").alias("instances"), F.count("*").alias("tokens")
    )
    usual = staged(counted.where(F.col("instances") >= LEAST_SEEDS).select("pattern", "tokens"), "patterns")
    # A pattern's confidence is at most its tokens by its places. Places in a part of
    # the corpus are a lower bound of all, so common pairs of words are ruled out there
    # for certain, and only what may be confident is counted everywhere.
    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(PART_OF)) == 0)
    bound = usual.join(_places(part, usual.select("pattern")), "pattern", "left")
    open_ = F.coalesce(F.col("places"), F.lit(0)) * CONFIDENT <= F.col("tokens")
    usual = staged(bound.where(open_).select("pattern"), "patterns")
    places = staged(_places(docs, usual), "places")
    # A seed is accepted wherever it stands, also where no base span lies over it.
    seeds = graph.groupBy("instance").agg(F.max("seed").alias("seed"))
    edges = staged(
        graph.drop("seed")
        .join(places, "pattern")
        .groupBy("instance", "pattern", "places")
        .agg(F.count("*").alias("times"))
        .join(seeds, "instance"),
        "edges",
    )
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    known = -1
    while True:
        confidence = staged(_confidences(edges, scores), "confidence")
        scores = staged(_scores(edges, confidence), "scores")
        accepted = scores.where(F.col("score") >= ACCEPTED).count()
        if accepted == known:
            break
        known = accepted
    sure = confidence.where(F.col("confidence") >= CONFIDENT)
    return (
        graph.where("not seed")
        .join(sure.select("pattern"), "pattern", "left_semi")
        .join(scores.where(F.col("score") >= ACCEPTED).select("instance"), "instance", "left_semi")
        .select("row", "start", "end")
        .distinct()
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row: array of (start, kind, end) in code points.

    Sorted by start, then kind in the order of ``KINDS``; the end is exclusive. A missing
    text counts as empty and has no span. Long texts are read whole; repeated rows give
    one row each; an empty table gives an empty result; other columns are not looked at.
    """
    found = staged(_found(docs), "found")
    learned = discover(docs, found).select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(KINDS.index("id")).alias("kind"), "start", "end"
    )
    base = found.where("kind = -1 or valid").select("row", "doc_id", "kind", "start", "end")
    span = F.when(F.col("kind") >= 0, F.struct("start", "kind", "end"))
    return (
        base.unionByName(learned)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("spans"))
        .drop("row")
    )


def span_report(docs: DataFrame) -> DataFrame:
    """Counts of base spans, a hash of them, and all spans as text, one row each."""
    names = ", ".join(f"'{k}'" for k in KINDS)

    def joined(spans: str) -> Column:
        return F.expr(
            f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"
        )

    counts = [
        F.expr(f"CAST(size(filter(spans, s -> s.kind = {k})) AS BIGINT)").alias(f"n_{name}")
        for k, name in enumerate(RULES)
    ]
    base = f"filter(spans, s -> s.kind < {len(RULES)})"
    return personal_data(docs).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
