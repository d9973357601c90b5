"""Information-theoretic sanitisation of personal data (DataFrame functions only).

Protected entities are the values of base patterns: e-mail addresses, IP numbers, payment cards
(Luhn) and phone numbers.  A term that stands near an entity discloses it when seeing the
term tells which entity is meant.  From counts over the whole corpus,

    disclosure(t, e) = P(e | t) = (documents with t near e + PRIOR P(e)) / (documents with t + PRIOR)
    information(t, e) = log2(P(e | t) / P(e))

smoothed towards P(e) by ``prior`` documents, so rare terms are judged by the estimate and not
cut off by a count (a term in one document, near the entity, reaches just over 1/2).  Every
row counts as a document, copies included.  A term is disclosing when P(e | t) reaches
``generalise_at`` and the information is at least ``min_bits``.  Where it reaches ``remove_at``
the term is removed, below that generalised to its first letter.  A term is a run of letters,
marks and digits of any script; in scripts written without spaces, whose runs are not words,
every two neighbouring characters are one (a lone one is a term by itself).  Terms
change at every place in the documents that hold the entity, near it or not; a document
without personal data is never touched, so the term stays readable there.

Positions come from the texts between matches (``split``) and the matches themselves; no row
leaves the JVM.  Term counts are summed map-side first; nothing is broadcast by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, with look-behinds and possessive repeats that keep every match and let a
# failed start be left at once (a run without @, or a long digit run, is read once).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\u30FC\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
SPACED = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_UNSPACED}]]"
UNSPACED = rf"[{_UNSPACED}&&[\p{{L}}\p{{M}}\p{{N}}]]"
TERM = rf"(?:{SPACED}++|{UNSPACED}++)"  # a whole run; runs of unspaced scripts are taken apart by _pieces

CONTEXT = 120  # characters on either side of an entity in which a term is near
PRIOR = 1.0  # documents by which P(e | t) is drawn towards P(e)
GENERALISE_AT = 0.5
REMOVE_AT = 0.8
MIN_BITS = 4.0

_SPAN = "struct<start:int,end:int,value:string>"


def located(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value), code points, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["between"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.filter(F.arrays_zip(found.alias("found"), between.alias("between")), lambda p: p["found"].isNotNull())
    return F.aggregate(pairs, first, step, lambda acc: acc["spans"])


def _term(value: Column) -> Column:
    """The case-free form of a term (a final sigma depends on what follows)."""
    return F.translate(F.lower(value), "ς", "σ")


def _pieces(value: Column) -> Column:
    """The terms of a run: array of (offset, value, whole); pairs of neighbours in an unspaced script."""
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.length(value) - 2, F.lit(0))),
                        lambda i: F.struct(i.alias("offset"), F.substring(value, i + 1, F.lit(2)).alias("value"),
                                           F.lit(False).alias("whole")))
    one = F.array(F.struct(F.lit(0).alias("offset"), value.alias("value"), F.lit(True).alias("whole")))
    return F.when((F.length(value) > 1) & value.rlike(f"^{UNSPACED}"), pairs).otherwise(one)


def _terms_of(text: Column) -> Column:
    """The different terms of a text."""
    runs = F.regexp_extract_all(text, F.lit(rf"{SPACED}++|(?<!{UNSPACED}){UNSPACED}(?!{UNSPACED})"), F.lit(0))
    pairs = F.when(text.rlike(UNSPACED), F.regexp_extract_all(text, F.lit(rf"(?=({UNSPACED}{{2}}))"), F.lit(1))) \
        .otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(runs, pairs))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check of a digit string."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(span["value"], r"\.", -1),
                        lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.regexp_replace(p, "^0+(?=.)", "").substr(1, 4).cast("int") <= 255))
    if kind == "card":
        return luhn(_digits(span["value"]))
    if kind == "phone":
        return F.length(_digits(span["value"])).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text: array of (start, kind number, end, value), in order."""
    def of(kind: str, pattern: str, guard: str) -> Column:
        number = KINDS.index(kind)
        spans = F.transform(
            F.filter(located(text, pattern), lambda s: _valid(kind, s)),
            lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("k"), s["end"].alias("end"),
                               s["value"].alias("value")))
        none = F.array().cast("array<struct<start:int,k:int,end:int,value:string>>")
        return F.when(text.contains(guard) if guard else text.rlike("[0-9]"), spans).otherwise(none)

    return F.sort_array(F.concat(of("email", EMAIL, "@"), of("ip", IP, "."), of("card", CARD, ""),
                                 of("phone", PHONE, "+")))


def _entity(k: Column, value: Column) -> Column:
    return F.concat_ws(":", k.cast("string"), F.when(k >= 2, _digits(value)).otherwise(F.lower(value)))


def _nearby(hits: DataFrame) -> DataFrame:
    """``doc_id, tie, copies, entity, term, start, end``: terms in the context of each base span."""
    each = hits.select("doc_id", "tie", "copies", "text", "base", F.explode("base").alias("s"))
    left_at = F.greatest(F.col("s.start") - CONTEXT, F.lit(0))
    sides = each.select("doc_id", "tie", "copies", "base", _entity(F.col("s.k"), F.col("s.value")).alias("entity"), F.explode(F.array(
        F.struct(left_at.alias("at"), F.substring("text", left_at + 1, F.col("s.start") - left_at).alias("part"),
                 (left_at > 0).alias("cut_left"), F.lit(False).alias("cut_right")),
        F.struct(F.col("s.end").alias("at"), F.substring("text", F.col("s.end") + 1, F.lit(CONTEXT)).alias("part"),
                 F.lit(False).alias("cut_left"),
                 (F.length("text") > F.col("s.end") + CONTEXT).alias("cut_right")))).alias("side"))
    sides = sides.select("doc_id", "tie", "copies", "base", "entity", "side.*")
    runs = sides.withColumn("r", F.explode(located(F.col("part"), TERM)))
    terms = runs.withColumn("t", F.explode(_pieces(F.col("r.value"))))
    terms = terms.filter(~F.col("t.whole") | (~(F.col("cut_left") & (F.col("r.start") == 0))
                                              & ~(F.col("cut_right") & (F.col("r.end") == F.length("part")))))
    start = F.col("at") + F.col("r.start") + F.col("t.offset")
    terms = terms.select("doc_id", "tie", "copies", "base", "entity", _term(F.col("t.value")).alias("term"),
                         start.alias("start"), (start + F.length("t.value")).alias("end"))
    clear = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    return terms.filter(clear).select("doc_id", "tie", "copies", "entity", "term", "start", "end")


def _places(texts: DataFrame) -> DataFrame:
    """``doc_id, tie, term, start, end``: all terms of whole texts, one row per (doc_id, tie) given.

    Positions are running sums over a text's pieces, so the work is linear in its length."""
    pieces = F.arrays_zip(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("found"),
                          F.split("text", TERM, -1).alias("between"))
    each = texts.select("doc_id", "tie", F.posexplode(pieces).alias("i", "p")).select(
        "doc_id", "tie", "i", F.col("p.found").alias("found"),
        (F.length("p.between") + F.coalesce(F.length("p.found"), F.lit(0))).alias("size"))
    end = F.sum("size").over(Window.partitionBy("doc_id", "tie").orderBy("i")).cast("int")
    placed = each.withColumn("end", end).filter(F.col("found").isNotNull())
    terms = placed.withColumn("t", F.explode(_pieces(F.col("found"))))
    start = F.col("end") - F.length("found") + F.col("t.offset")
    return terms.select("doc_id", "tie", _term(F.col("t.value")).alias("term"), start.alias("start"),
                        (start + F.length("t.value")).alias("end"))


def _marked(hits: DataFrame, strong: DataFrame) -> DataFrame:
    """``doc_id, tie, start, end, disclosure``: every place of a disclosing term in the documents that hold its entity."""
    entities = F.array_distinct(F.transform("base", lambda s: _entity(s["k"], s["value"])))
    wanted = hits.select("doc_id", "tie", F.explode(entities).alias("entity")).join(strong, "entity") \
        .groupBy("doc_id", "tie", "term").agg(F.max("disclosure").alias("disclosure")) \
        .withColumnsRenamed({"doc_id": "_d", "tie": "_t", "term": "_term"})
    wanted = materialize(wanted, "pii_wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t"))
    texts = hits.select("doc_id", "tie", "text").join(wanted.select("_d", "_t").distinct(), same, "left_semi")
    return _places(texts).join(wanted, same & (F.col("term") == F.col("_term")))


def disclosing_terms(docs: DataFrame, near: DataFrame, prior: float = PRIOR,
                     generalise_at: float = GENERALISE_AT, min_bits: float = MIN_BITS) -> DataFrame:
    """``term, entity, disclosure, bits`` of the terms over the thresholds."""
    once = near.select("doc_id", "tie", "copies", "term", "entity").distinct()
    joint = once.groupBy("term", "entity").agg(F.sum("copies").alias("joint"))
    entity = near.select("doc_id", "tie", "copies", "entity").distinct().groupBy("entity").agg(F.sum("copies").alias("with_entity"))
    counts = docs.select(F.explode(_terms_of(_term(F.col("text")))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    total = docs.agg(F.count(F.lit(1))).first()[0]
    share = F.col("with_entity") / F.lit(max(total, 1))
    scored = joint.join(counts, "term").join(entity, "entity").withColumn(
        "disclosure", F.least(F.lit(1.0), (F.col("joint") + prior * share) / (F.col("with_term") + prior))).withColumn(
        "bits", F.log2(F.col("disclosure") / share))
    return scored.filter((F.col("disclosure") >= generalise_at) & (F.col("bits") >= min_bits)) \
        .select("term", "entity", "disclosure", "bits")


def personal_spans(docs: DataFrame, remove_at: float = REMOVE_AT, **thresholds) -> DataFrame:
    """One row per input row: ``doc_id, base, terms`` (and ``tie``, a hash of the text).

    ``base`` holds (start, k, end, value) with k the number in ``KINDS``; ``terms`` holds
    (start, end, removed) of disclosing terms.  Starts count code points, ends are exclusive.
    Null and empty texts have no spans.  Null ids are values like others; repeated rows give
    repeated results (counts see each row).  An empty table gives an empty one.  Only
    ``doc_id`` and ``text`` are read.
    """
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    found = given.filter(F.col("text").rlike("[0-9@]")).withColumn("base", base_spans(F.col("text")))
    hits = materialize(found.filter(F.size("base") > 0), "pii_hits")
    once = hits.groupBy("doc_id", "tie").agg(F.first("text").alias("text"), F.first("base").alias("base"),
                                             F.count(F.lit(1)).alias("copies"))
    near = materialize(_nearby(once), "pii_near")
    strong = disclosing_terms(given, near, **thresholds)
    marked = _marked(once, strong).groupBy("doc_id", "tie", "start", "end") \
        .agg((F.max("disclosure") >= remove_at).alias("removed")) \
        .groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("terms"))
    marked = marked.withColumnsRenamed({"doc_id": "_d", "tie": "_t"})
    with_terms = once.drop("text", "copies").join(
        marked, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")), "left").drop("_d", "_t")
    # a term inside a base span is masked with it
    with_terms = with_terms.withColumn("terms", F.filter("terms", lambda t: ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    spans = with_terms.withColumnsRenamed({"doc_id": "_d", "tie": "_t"})
    return given.select("doc_id", "tie").join(
        spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")), "left").select(
        "doc_id", "tie",
        F.coalesce("base", F.array().cast("array<struct<start:int,k:int,end:int,value:string>>")).alias("base"),
        F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,removed:boolean>>")).alias("terms"))


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``doc_id, text``: base spans become ``<KIND>``; disclosing terms go, or keep their first letter.

    Overlapping spans are masked once, under the first one's name.
    """
    spans = personal_spans(docs, **thresholds).dropDuplicates(["doc_id", "tie"]) \
        .filter(F.size("base") > 0).withColumnsRenamed({"doc_id": "_d", "tie": "_t"})
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    joined = given.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")), "left")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    masks = F.sort_array(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                               F.element_at(names, s["k"] + 1).alias("mask"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
            s["removed"], F.lit("")).otherwise(
            F.concat(F.substring(F.col("text"), s["start"] + 1, F.lit(1)), F.lit("*"))).alias("mask")))))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, m: Column) -> Column:
        fresh = m["start"] >= acc["at"]
        lead = F.substring(F.col("text"), acc["at"] + 1, m["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], m["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["parts"], F.array(lead, m["mask"]))).otherwise(acc["parts"]).alias("parts"))

    rebuilt = F.aggregate(masks, first, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return joined.select("doc_id", F.when(F.col("base").isNull(), F.col("text")).otherwise(rebuilt).alias("text"))


def digest(spans: DataFrame) -> DataFrame:
    """The contract columns over ``personal_spans``."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(s: Column) -> Column:
        return F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))

    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"),
                                                  F.element_at(names, s["k"] + 1).alias("name")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("k"),
                                                    s["end"].alias("end"), F.lit("term").alias("name")))

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == number)).cast("long").alias(f"n_{KINDS[number]}")

    return spans.select(
        "doc_id", *[count(number) for number in range(len(KINDS))],
        F.sha2(F.array_join(F.transform(F.sort_array(base), written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.sort_array(F.concat(base, terms)), written), ",").alias("spans"))
