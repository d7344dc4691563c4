"""Personal data by rules and by bootstrapped contextual extraction, in DataFrame
functions alone.

Rules find emails, IPv4 addresses, payment cards and phone numbers (the base spans).
These seed the bootstrap: the one and two words before a seed are lexical patterns;
patterns and instances form a graph that is scored in rounds:

- a pattern's confidence for a kind is the weight of that kind's known instances among
  these, known instances of other kinds and strings whose shape is not one of the
  kind's, with one more counter-example than seen, and needs ``SUPPORT`` known instances;
- a kind's shape (number of digits with some slack, letters or none, an at sign or none,
  separators) is taken anew in each round from what is known of the kind;
- a candidate (a string that looks like the kind but isn't matched by its rule, such
  as a phone number without a country code, or any chain of digits or token with a
  digit or an at sign that has the kind's shape) gets ``1 - prod(1 - confidence)`` over its patterns;
- candidates with ``ACCEPT`` or more are known in the next round, with their score as weight.

Candidates known after the last round become spans.  One pass reads the texts; what it
keeps are the matches with a few characters before them, once for each distinct text.
Patterns start only where a match can start and use possessive repeats, so matching is
linear in the text.  Running sums over gaps and matches give positions in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

KINDS = ["email", "ip", "card", "phone"]
SUPPORT = 3
ACCEPT = 0.8
ROUNDS = 3
#: Characters before a match that its pattern is taken from.
CONTEXT = 64

_LOCAL = "A-Za-z0-9._%+-"
RULES = {
    # a match starts where its run starts, or where the match before it ended
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole chain of digits of the right count
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOKS_LIKE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\]|\{{dot\}})\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z._/])[0-9]{4}(?:[._/][0-9]{4}){3}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
#: Candidates of any kind, which their shape and context decide: chains of digit groups, and tokens without the punctuation around them.
LOOSE = {
    "chain": r"(?<![\p{L}0-9:@+._/-])(?<![0-9][\x20)._/-]{1,3})\(?[0-9]++(?:\)?[\x20._/-]{1,2}+\(?[0-9]++){1,9}+(?![\p{L}0-9:@])(?!\)?[\x20._/-]{1,2}\(?[0-9])",
    "word": r"(?<![^\s(\[<\x22',;])(?=[^\s0-9@]{0,64}+[0-9@])[\p{L}0-9:+](?:\S{0,64}[\p{L}0-9])?(?![\p{L}0-9])",
}
#: Any other token with a digit or an at sign: what patterns are held against.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

_OCTET = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def part(i: Column) -> Column:
        x = F.substr(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    return (F.when(kind == "ip", value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(kind == "card", n.between(13, 19) & _luhn(_digits(value)))
            .when(kind == "phone", n.between(9, 15)).otherwise(F.lit(True)))


def _matches(text: Column, pattern: str, hint: str | None = None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if hint is None else F.when(F.contains(text, F.lit(hint)), found).otherwise(F.array().cast("array<string>"))


_HINTS = {("rule", "email"): "@", ("rule", "phone"): "+", ("like", "email"): "at", ("like", "ip"): ":"}


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, digest`` of every row, ``digest, class, kind, start, end, value, before``
    of every match in every distinct text).  ``class``: rule, like, loose or token; ``start`` and
    ``end`` (exclusive) in code points.  The digest is the text's SHA-256."""
    patterns = ([("rule", k, p) for k, p in RULES.items()] + [("like", k, p) for k, p in LOOKS_LIKE.items()]
                + [(c, "", p) for c, p in LOOSE.items()] + [("token", "", TOKEN)])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    d = d.select("doc_id", "digest", "text", *[_matches(F.col("text"), p, _HINTS.get((c, k))).alias(f"m{i}") for i, (c, k, p) in enumerate(patterns)])
    none = F.array().cast("array<struct<gap:int,before:string,value:string>>")

    def cut(i: int, pattern: str) -> Column:
        pieces = F.split(F.col("text"), pattern, -1)
        return F.when(F.size(f"m{i}") > 0, F.zip_with(
            F.transform(pieces, lambda x: F.struct(F.length(x).alias("gap"), F.right(x, F.lit(CONTEXT)).alias("before"))), F.col(f"m{i}"),
            lambda x, m: F.struct(x["gap"].alias("gap"), x["before"].alias("before"), m.alias("value")))).otherwise(none)

    hits = materialize(d.select("doc_id", "digest", *[cut(i, p).alias(f"c{i}") for i, (_, _, p) in enumerate(patterns)]), "pii_scan")
    some = F.lit(False)
    for i in range(len(patterns)):
        some = some | (F.size(f"c{i}") > 0)
    once = hits.where(some).groupBy("digest").agg(*[F.first(f"c{i}").alias(f"c{i}") for i in range(len(patterns))])

    def named(cls: str, kind: str):
        return lambda x, at: F.struct(F.lit(cls).alias("class"), F.lit(kind).alias("kind"), at.alias("at"), x["gap"].alias("gap"),
                                      x["before"].alias("before"), x["value"].alias("value"))

    every = F.flatten(F.array(*[F.transform(f"c{i}", named(c, k)) for i, (c, k, _) in enumerate(patterns)]))
    rows = once.select("digest", F.explode(every).alias("x")).select("digest", "x.*").where("value is not null")
    upto = Window.partitionBy("digest", "class", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto))
            .withColumn("start", F.col("end") - F.length("value")).drop("gap", "at"))
    # a match that fails its rule is a token like any other
    rows = rows.withColumn("class", F.when((F.col("class") == "rule") & ~_valid(F.col("kind"), F.col("value")), "token").otherwise(F.col("class")))
    # a class counts where none before it holds
    # (both frames look back, since one that looks ahead is summed up anew for each row)
    before = Window.partitionBy("digest").orderBy("start", "end", "class").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("digest").orderBy(F.desc("start"), F.desc("end"), F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)

    def meets(*classes: str) -> Column:
        own = F.col("class").isin(*classes)
        return (F.coalesce(F.max(F.when(own, F.col("end"))).over(before) > F.col("start"), F.lit(False))
                | F.coalesce(F.min(F.when(own, F.col("start"))).over(after) < F.col("end"), F.lit(False)))

    ranks = ["rule", "like", "chain", "word", "token"]
    keep = F.col("class") == "rule"
    for i, c in enumerate(ranks[1:], 1):
        rows = rows.withColumn(f"_{c}", meets(*ranks[:i]))
        keep = keep | ((F.col("class") == c) & ~F.col(f"_{c}"))
    rows = rows.where(keep).drop(*[f"_{c}" for c in ranks])
    rows = rows.withColumn("class", F.when(F.col("class").isin("chain", "word"), "loose").otherwise(F.col("class")))
    return hits.select("doc_id", "digest"), rows


def _shape(value: Column) -> Column:
    """Number of digits, whether there are letters, an at sign, and other characters than separators.
    In tokens of hexadecimal digits and colons all of these are digits."""
    hexadecimal = value.rlike("^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$")
    return F.struct(F.when(hexadecimal, F.length(F.regexp_replace(value, "[^0-9A-Fa-f]", ""))).otherwise(F.length(_digits(value))).alias("digits"),
                    (~hexadecimal & value.rlike(r"\p{L}")).cast("int").alias("letters"),
                    value.rlike(r"@|[(\[{]at[)\]}]").cast("int").alias("at"),
                    value.rlike(r"[^\p{L}0-9\x20().:/_+@-]").cast("int").alias("other"))


def _plausible(known: DataFrame, loose: DataFrame) -> DataFrame:
    """``pattern, value, kind`` of the loose strings with a shape that ``known`` instances of the kind span."""
    seen = known.select("kind", "value").distinct().select("kind", _shape(F.col("value")).alias("s"))
    spans = seen.groupBy("kind").agg(F.ceil(F.min("s.digits") * 0.75).alias("least"), F.floor(F.max("s.digits") * 1.25).alias("most"),
                                     *[f(f"s.{k}").alias(f"{n}_{k}") for k in ("letters", "at", "other") for n, f in (("lo", F.min), ("hi", F.max))])
    own = loose.withColumn("s", _shape(F.col("value"))).drop("kind").join(F.broadcast(spans))
    fits = (F.col("least") == 0) | F.col("s.digits").between(F.col("least"), F.col("most"))
    for k in ("letters", "other"):
        fits = fits & (F.col(f"s.{k}") <= F.col(f"hi_{k}"))
    return own.where(fits & F.col("s.at").between(F.col("lo_at"), F.col("hi_at"))).select("pattern", "value", "kind")


def score(rows: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """``class, kind, value, score`` of the candidates that the pattern-instance graph accepts."""
    word = F.lower(F.regexp_replace("before", "[0-9]", "0"))
    two = F.regexp_extract(word, r"(\S+)\s+(\S+)\s*$", 0)
    contexts = F.array_distinct(F.array(F.regexp_extract(word, r"(\S+)\s*$", 1), F.regexp_replace(F.trim(two), r"\s+", " ")))
    edges = materialize(rows.select("class", "kind", "value", F.explode(contexts).alias("pattern")).where("pattern != ''").distinct(), "pii_edges")
    rule, like, loose = (edges.where(F.col("class") == c) for c in ("rule", "like", "loose"))
    # tokens have no kind's shape; a pattern without a rule's instance is never trusted in the first round, nor one without a known one later
    odd = edges.where(F.col("class").isin("token", "loose")).groupBy("pattern").agg(F.count(F.lit(1)).alias("odd"))
    known = like.select("class", "kind", "value", F.lit(0.0).alias("score")).where(F.lit(False))
    for _ in range(rounds):
        shaped = materialize(_plausible(rule.select("kind", "value").unionByName(known.select("kind", "value")), loose)
                             .withColumn("class", F.lit("loose")), "pii_shaped")
        candidates = like.select("class", "kind", "value", "pattern").unionByName(shaped)
        weight = (rule.select("kind", "pattern", F.lit(1.0).alias("w"))
                  .unionByName(candidates.join(known, ["class", "kind", "value"]).select("kind", "pattern", F.col("score").alias("w"))))
        kinds = weight.groupBy("pattern", "kind").agg(F.sum("w").alias("good"))
        total = kinds.groupBy("pattern").agg(F.sum("good").alias("total"))
        own = shaped.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("own"))
        against = F.col("total") + F.coalesce("odd", F.lit(0)) - F.coalesce("own", F.lit(0))
        trust = (kinds.where(F.col("good") >= support).join(total, "pattern").join(odd, "pattern", "left").join(own, ["pattern", "kind"], "left")
                 .select("pattern", "kind", (F.col("good") / (against + 1)).alias("confidence")))
        known = materialize(candidates.join(trust, ["pattern", "kind"]).groupBy("class", "kind", "value")
                            .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score")).where(F.col("score") >= accept), "pii_known")
    return known


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, digest`` of every row, ``digest, kind, start, end, base`` of every span in
    every distinct text).  Null and empty texts have no spans; rows of equal texts share them."""
    keys, rows = scan(docs)
    rows = materialize(rows, "pii_rows")
    known = score(rows)
    base = rows.where(F.col("class") == "rule").select("digest", "kind", "start", "end", F.lit(True).alias("base"))
    more = (rows.where(F.col("class") == "like").join(known.where(F.col("class") == "like"), ["kind", "value"], "left_semi")
            .select("digest", "kind", "start", "end", F.lit(False).alias("base")))
    best = known.where(F.col("class") == "loose").groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    rest = (rows.where(F.col("class") == "loose").drop("kind").join(best, "value")
            .select("digest", "kind", "start", "end", F.lit(False).alias("base")))
    return keys, base.unionByName(more).unionByName(rest)


def per_document(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (all spans) ``, base, spans`` of every row; the
    last two as ``kind:start:end`` in order of kind as listed, then start, joined by commas."""
    keys, found = spans(docs)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.struct(rank.alias("rank"), "start", "end", F.concat_ws(":", "kind", "start", "end").alias("span"), "base")
    text = (found.groupBy("digest").agg(F.sort_array(F.collect_list(one)).alias("all"), *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in KINDS])
            .select("digest", *[f"n_{k}" for k in KINDS],
                    F.array_join(F.transform(F.filter("all", lambda x: x["base"]), lambda x: x["span"]), ",").alias("base"),
                    F.array_join(F.transform("all", lambda x: x["span"]), ",").alias("spans")))
    return keys.join(text, "digest", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets (overlapping
    spans by the first one's, once); rows, other columns and null texts stay as they are."""
    _, found = spans(docs)
    order = Window.partitionBy("digest").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.coalesce(F.col("start") >= F.col("_reach"), F.lit(True)), 1).otherwise(0)
    runs = (found.withColumn("_reach", reach).withColumn("_run", F.sum(new).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("digest", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                           F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind")))
    own, digest = fresh(docs, "pii_runs"), fresh(docs, "pii_digest")
    runs = (runs.withColumn("from", F.coalesce(F.lag("end").over(Window.partitionBy("digest").orderBy("start")), F.lit(0)))
            .groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("start", "end", "from", "kind"))).alias(own)).withColumnRenamed("digest", digest))
    text = F.col("text")
    pieces = F.transform(own, lambda r: F.concat(
        F.substr(text, (r["from"] + 1).cast("int"), (r["start"] - r["from"]).cast("int")), F.lit("<"), F.upper(r["kind"]), F.lit(">")))
    last = F.element_at(own, -1)["end"].cast("int")
    whole = F.concat(F.array_join(pieces, ""), F.substr(text, last + 1, F.length(text) - last))
    keyed = docs.withColumn(digest, F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))
    return (keyed.join(runs, digest, "left").withColumn("text", F.when(F.col(own).isNull(), text).otherwise(whole)).select(*docs.columns))
