"""Personal data: seed patterns, then contextual patterns learned from them; DataFrame functions only."""

from pyspark.sql import functions as F

from .common import materialise

# The base patterns of the contract. Word-start guards and possessive quantifiers only spare the
# matcher attempts that cannot succeed; the matches are those of the plain patterns.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){12}[0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: A word that holds a digit.
MENTION = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9]*+[0-9])[^\x20\x09-\x0D]++"
#: An unseen identifier has eight such characters at least, two of them digits.
IDENTIFIER = r"^(?=[^0-9]*[0-9][^0-9]*[0-9])[A-Za-z0-9._@+/-]{8,}$"
FOUND = "id"

CONTEXT = 64
LEAST_SUPPORT = 3.0
CONFIDENT = 0.8


def _luhn(card):
    digits = F.reverse(F.regexp_replace(card, "[^0-9]", ""))

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _matches(text, pattern):
    """All matches in order: m (the match), b and e (code points, end exclusive), c (up to 64 characters before).

    The regex functions give no places; the lengths of the pieces between the matches and of the matches do.
    """
    kind = "array<struct<m:string,b:int,e:int,c:string>>"
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("s"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).alias("p"), F.array().cast(kind).alias("o"))

    def step(a, x):
        begin = a.p + F.length(x.s)
        end = begin + F.coalesce(F.length(x.m), F.lit(0))
        row = F.struct(x.m.alias("m"), begin.alias("b"), end.alias("e"), F.right(x.s, F.lit(CONTEXT)).alias("c"))
        return F.struct(end.alias("p"), F.when(x.m.isNull(), a.o).otherwise(F.concat(a.o, F.array(row))).alias("o"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step, lambda a: a.o)).otherwise(F.array().cast(kind))


def _base(kind, text):
    def valid(x):
        m = x.m
        digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
        if kind == "ip":
            part = lambda p: F.ltrim(p, F.lit("0"))
            return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
        if kind == "card":
            return digits.between(13, 19) & _luhn(m)
        return digits.between(9, 15) if kind == "phone" else F.lit(True)

    named = lambda x: F.struct(F.lit(kind).alias("k"), x.m.alias("m"), x.b.alias("b"), x.e.alias("e"), x.c.alias("c"))
    return F.transform(F.filter(_matches(text, KINDS[kind]), valid), named)


def _candidate(x):
    """Body of a word after its head (up to the last quote, bracket, = : #) and without closing punctuation."""
    core = F.regexp_replace(x.m, "[.,;:!?\"'()\\]}>]+$", "")
    head = F.regexp_extract(core, "^(.*[=:\"'#(\\[{<])?", 1)
    begin = x.b + F.length(head)
    end = x.b + F.length(core)
    return F.struct(
        F.lit(FOUND).alias("k"), F.substr(core, F.length(head) + 1).alias("m"), begin.alias("b"), end.alias("e"),
        F.concat(x.c, head).alias("c"), head.alias("head"),
    )


def mentions(docs, keep=()):
    """Row per row of `docs`: a row number, the base spans and the identifier-shaped words outside them; written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = rows.select(
        *keep, "doc_id", "text", F.concat(*[_base(k, F.col("text")) for k in KINDS]).alias("base"),
    ).withColumn("words", F.transform(_matches(F.col("text"), MENTION), _candidate))
    outside = F.filter(
        "words",
        lambda w: w.m.rlike(IDENTIFIER) & ~F.exists("base", lambda s: (s.b < w.e) & (w.b < s.e)),
    )
    return materialise(
        base.select(*keep, "doc_id", "base", outside.alias("words"), F.xxhash64("text").alias("text_key"))
        .withColumn("row_id", F.monotonically_increasing_id())
    )


def _edges(found):
    """Distinct (pattern, instance, seed): the words before an entity and the head glued to it, as patterns."""
    seeds = found.select(F.explode("base").alias("x")).select("x.m", "x.c", F.lit("").alias("head"), F.lit(1.0).alias("seed"))
    words = found.select(F.explode("words").alias("x")).select("x.m", "x.c", "x.head", F.lit(0.0).alias("seed"))
    both = seeds.union(words).withColumn("c", F.expr("left(c, length(c) - length(head))")).withColumn(
        "left", F.regexp_replace(F.lower(F.regexp_extract("c", r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+)?([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 0)), "[0-9]", "0")
    )
    last = F.regexp_extract("left", r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 1)
    patterns = F.array(
        F.when(last != "", F.concat(F.lit("1|"), last)),
        F.when(F.col("left") != "", F.concat(F.lit("2|"), F.regexp_replace(F.trim("left"), r"[\x20\x09-\x0D]+", " "))),
        F.when(F.col("head") != "", F.concat(F.lit("h|"), F.col("head"))),
    )
    return (
        both.select("m", "seed", F.explode(F.array_compact(patterns)).alias("pattern"))
        .groupBy("pattern", F.col("m").alias("instance")).agg(F.max("seed").alias("seed"))
    )


def discovered(found):
    """Identifiers that trusted contexts single out: instance, score.

    Patterns and instances form a bipartite graph. Each round a pattern's confidence is the mean score of its
    instances (one more counted as wrong), if they add up to LEAST_SUPPORT; an unseen instance scores as likely
    as that any of its patterns of CONFIDENT or more is right. Seeds keep score 1. Each round is one grouping by
    pattern and one by instance, both pre-aggregated, and is written. Scores only rise from round to round; the
    rounds end when no instance newly has a score and none rose in its first six decimals.
    """
    edges = materialise(_edges(found))
    scores, mark = None, (0, 0)
    while True:
        known = edges.withColumn("score", F.col("seed"))
        if scores is not None:
            known = edges.join(scores, "instance", "left").withColumn("score", F.greatest("seed", F.coalesce("score", F.lit(0.0))))
        trust = (
            known.groupBy("pattern").agg(F.sum("score").alias("support"), F.count(F.lit(1)).alias("n"))
            .filter(F.col("support") >= LEAST_SUPPORT).withColumn("trust", F.col("support") / (F.col("n") + 1))
            .filter(F.col("trust") >= CONFIDENT).select("pattern", "trust")
        )
        scores = materialise(
            edges.filter("seed = 0").join(trust, "pattern").groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log(1.000001 - F.col("trust"))))).alias("score"))
        )
        after = tuple(scores.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.floor(F.col("score") * 1e6)), F.lit(0))).first())
        if after <= mark:
            return scores.filter(F.col("score") >= CONFIDENT)
        mark = after


def _sorted_spans(spans):
    order = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(order, s.k).alias("o"), s.b.alias("b"), s.e.alias("e"), s.k.alias("k")))
    return F.array_sort(F.array_distinct(keyed))


def _written(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.k, s.b, s.e)), ",")


def find(docs):
    """Row per row of `docs`: doc_id, text_key, base and spans, arrays of (o, b, e, k) by kind, then start.

    Base spans follow the fixed patterns over the whole text; words that hold digits, have the shape of an
    identifier and stand where identifiers stand (see `discovered`) are added as kind "id". Null text: empty.
    Null doc_id and repeated rows keep a row each. An empty table gives an empty result; columns other than
    doc_id and text are ignored.
    """
    found = mentions(docs)
    more = (
        found.filter(F.size("words") > 0).select("row_id", F.explode("words").alias("x"))
        .join(discovered(found).select(F.col("instance")), F.col("x.m") == F.col("instance"))
        .groupBy("row_id").agg(F.collect_list(F.struct("x.k", "x.m", "x.b", "x.e", "x.c")).alias("more"))
    )
    none = F.array().cast("array<struct<k:string,m:string,b:int,e:int,c:string>>")
    return found.join(more, "row_id", "left").select(
        "doc_id", "text_key", _sorted_spans(F.col("base")).alias("base"),
        _sorted_spans(F.concat("base", F.coalesce("more", none))).alias("spans"),
    )


def report(docs):
    """`find` as counts and strings: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    def number(kind):
        return F.size(F.filter("base", lambda s: s.k == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return find(docs).select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def masked(docs):
    """The rows of `docs`, all columns, with every span of the text replaced by its kind in capitals and brackets."""
    spans = find(docs).filter(F.size("spans") > 0).select(F.col("doc_id").alias("span_id"), "text_key", "spans").dropDuplicates(["span_id", "text_key"])
    whole = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")
    )
    joined = whole.join(spans, F.expr("id <=> span_id and key = text_key"), "left")
    text = F.col("row.text")
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s.b.alias("b"), s.e.alias("e"), s.k.alias("k"))))

    def step(a, s):
        out = F.concat(a.out, F.substr(text, a.p + 1, s.b - a.p), F.lit("["), F.upper(s.k), F.lit("]"))
        return F.when(s.b >= a.p, F.struct(s.e.alias("p"), out.alias("out"))).otherwise(F.struct(F.greatest(a.p, s.e).alias("p"), a.out.alias("out")))

    start = F.struct(F.lit(0).alias("p"), F.lit("").alias("out"))
    cleaned = F.aggregate(by_start, start, step, lambda a: F.concat(a.out, F.substr(text, a.p + 1)))
    new_text = F.when(F.col("spans").isNull(), text).otherwise(cleaned)
    names = [n for n in docs.columns]
    return joined.select(*[new_text.alias(n) if n == "text" else F.col(f"row.`{n}`").alias(n) for n in names])
