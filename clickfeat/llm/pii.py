"""Personal data: patterns, then information-theoretic sanitisation.

Base spans come from four patterns (email, ip, card, phone).  Their values are the protected
entities.  For every entity the words around its occurrences are counted, by documents, and so
are all words of the corpus.  With N documents, n(e) holding entity e, n(t) holding term t and
n(e,t) holding t as a whole word within REACH characters of e (not beyond the next entity of its kind; a number that
fails its kind's check is no entity), the pointwise mutual information
log2(N n(e,t) / (n(e) n(t))) is how many of the log2(N / n(e)) bits that identify e the term
discloses.  All four are exact counts of different (doc_id, text).

A term that discloses at least DISCLOSED of them is sanitised wherever it occurs, if their meeting is no chance: of c
independent contexts of e, k hold t, which documents hold with a share of q = n(t) / N; the probability of k or
more is at most exp(-c KL(k/c || q)) (Chernoff).  As every word of the corpus might have stood there, this is multiplied
by the number of different words, V (Bonferroni), and must then be at most CHANCE.  So a rare word beside an
entity that is met once tells nothing (q V is far above CHANCE), two meetings tell something in a
large corpus, and with more of them common words can tell as well.  The contexts of one
document, and copies of one passage, are not independent and count as one.

A name-like term (capital letter) is generalised to ``[NAME]``, one with digits to ``[NUMBER]``,
others are removed (``[...]``).  Base spans become ``[EMAIL]`` and so on; spans that overlap become one, named by the first.

Only column expressions, joins and aggregates are used.  Searching long texts stays linear: every
pattern starts only where a leftmost match can start and never gives back what it has read.

Defined cases: null text counts as empty, with empty spans and an empty sanitised text; rows
that share doc_id and text get the same result each; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickfeat.llm import common

KINDS = ["email", "ip", "card", "phone", "term"]
REACH = 80
DISCLOSED = 0.9
#: The greatest probability that any word of the corpus meets an entity as often by chance.
CHANCE = 0.01
#: Letters and digits of a term.
LEAST_TERM = 3

# (?<!x) or \G: a match starts at the front of a run or where the match before it ended, as a search from the left would
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
WORD = r"[^\p{L}\p{N}]+"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Does the string of digits pass the Luhn check?"""
    def add(total, i):
        v = F.substr(d, F.length(d) - i, F.lit(1)).cast("int")
        v = F.when(i % 2 == 1, 2 * v - F.when(v > 4, 9).otherwise(0)).otherwise(v)
        return total + v
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each base kind."""
    def found(needs: Column, pattern: str) -> Column:
        return F.when(needs & text.rlike(pattern), common.spans(text, pattern)).otherwise(common.no_spans())

    card = lambda m: F.length(digits(m)).between(12, 19)
    return {
        "email": found(text.contains("@"), EMAIL),
        "ip": F.filter(found(text.contains("."), IP), lambda x: x["m"].rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        "card": F.filter(F.when(text.rlike(r"[0-9](?:[\x20-]?+[0-9]){11}"), common.spans(text, CARD)).otherwise(common.no_spans()),
                         lambda x: F.when(card(x["m"]), luhn(digits(x["m"]))).otherwise(False)),
        "phone": F.filter(found(text.contains("+"), PHONE), lambda x: F.length(digits(x["m"])).between(9, 15)),
    }


def entity(kind: str, m: Column) -> Column:
    """The protected value: an address in lower case, a number's digits."""
    return F.lower(m) if kind in ("email", "ip") else digits(m)


def terms_of(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(text, WORD)), lambda w: F.length(w) >= LEAST_TERM)


def base_items() -> Column:
    return F.concat(*[common.kinded(F.col(k), i) for i, k in enumerate(KINDS[:4])])


def base_rows(docs: DataFrame) -> DataFrame:
    """doc_id, __h, the spans of each kind, around every entity its context, and the text with its base
    spans replaced (null where there are none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", common.text_hash().alias("__h"), text.alias("t"))
    d = common.fixed(d, **base_spans(F.col("t")))
    d = common.fixed(d, items=F.array_sort(base_items()))

    # the contexts follow the places of the spans that passed their checks
    d = common.fixed(d, cut=F.when(F.size("items") > 0, common.pieces(F.col("t"), REACH)))

    def around(kind: str) -> Column:
        beside = common.surroundings(F.col(kind), F.col("cut"), F.length("t"), REACH)
        return F.zip_with(F.col(kind), beside, lambda x, c: F.struct(F.concat(F.lit(kind + ":"), entity(kind, x["m"])).alias("e"), c.alias("c")))

    met = F.concat(*[around(k) for k in KINDS[:4]])
    flat = [F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS[:4]]
    return d.select("doc_id", "__h", *flat, met.alias("met"), F.when(F.size("items") > 0, cleaned(F.col("t"), F.col("cut"), F.col("items"))).alias("clean"))


def chance(k: Column, c: Column, q: Column) -> Column:
    """At most this is the probability that k or more of c independent contexts hold a term which a share q of all documents holds."""
    r = k / c
    kl = r * F.log(r / q) + F.when(k < c, (1 - r) * F.log((1 - r) / (1 - q))).otherwise(0.0)
    return F.when((q < 1) & (r > q), F.exp(-c * kl)).otherwise(1.0)


def disclosing_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(term, entity, share): the terms that disclose at least DISCLOSED of an entity's bits, and not by chance."""
    # rows that repeat both doc_id and text are one document in every count
    repeated = base.groupBy(F.col("doc_id").alias("__id"), F.col("__h").alias("__g")).agg((F.count(F.lit(1)) - 1).alias("more"))
    repeated = common.table(repeated.filter("more > 0"), "pii-repeated")
    more = repeated.agg(F.sum("more")).first()[0] or 0
    total = base.count() - more
    # one row per entity and document: all its contexts there
    met = base.select("doc_id", "__h", F.explode("met").alias("m")).groupBy("doc_id", "__h", "m.e").agg(F.array_sort(F.collect_set("m.c")).alias("c"))
    met = common.table(met.select("e", F.xxhash64("c").alias("ctx"), terms_of(F.array_join("c", " ")).alias("terms")), "pii-met")
    counts = [F.count(F.lit(1)), F.countDistinct("ctx")]
    # the context holds no text of the entity itself, so a term may well be a part of it
    pairs = met.select("e", "ctx", F.explode("terms").alias("term")).groupBy("e", "term")
    pairs = common.table(pairs.agg(counts[0].alias("n_et"), counts[1].alias("k")), "pii-pairs")
    if pairs.isEmpty():
        return pairs.select("term", F.col("e").alias("entity"), F.lit(None).cast("double").alias("share"))
    entities = met.groupBy("e").agg(counts[0].alias("n_e"), counts[1].alias("c"))
    entities = common.table(entities.join(pairs.groupBy("e").agg(F.count(F.lit(1)).alias("n")), "e"), "pii-entities")
    # the corpus's words are counted before they meet the pairs, so that join has a row per word
    held = docs.select("doc_id", common.text_hash().alias("__h"), F.coalesce("text", F.lit("")).alias("t"))
    words = held.select(F.explode(terms_of(F.col("t"))).alias("term"), F.lit(1).cast("long").alias("n"))
    if more:
        again = held.join(repeated, same_row()).groupBy("__id", "__g").agg(F.first("t").alias("t"), F.first("more").alias("more"))
        words = words.unionByName(again.select(F.explode(terms_of(F.col("t"))).alias("term"), (-F.col("more")).alias("n")))
    seen = Observation("pii-words")
    words = words.groupBy("term").agg(F.sum("n").alias("n_t")).observe(seen, F.count(F.lit(1)).alias("v"))
    words = common.table(words.join(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term", "left").filter("n is not null"), "pii-words")
    vocabulary = float(max(1, seen.get["v"]))
    # a frequent word stands near many entities, and many words stand near a frequent entity
    j = common.lookup(pairs, words, ["term"], F.col("e")).drop("n")
    j = common.lookup(j, entities, ["e"], F.col("term"))
    bits = F.log2(F.lit(float(total)) / F.col("n_e"))
    share = F.log2(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.when(bits > 0, bits)
    by_chance = chance(F.col("k"), F.col("c"), F.col("n_t") / F.lit(float(total))) * F.lit(vocabulary)
    return (j.select("term", F.col("e").alias("entity"), share.alias("share"), by_chance.alias("chance"))
            .filter((F.col("share") >= DISCLOSED) & (F.col("chance") <= CHANCE)).drop("chance"))


def holders(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(__id, __g, terms): the documents that hold disclosing terms."""
    d = docs.select(F.col("doc_id").alias("__id"), common.text_hash().alias("__g"), F.explode(terms_of(F.coalesce("text", F.lit("")))).alias("term"))
    return d.join(terms.select("term").distinct(), "term").groupBy("__id", "__g").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def term_rows(docs: DataFrame, base: DataFrame, held: DataFrame) -> DataFrame:
    """(__id, __g, term, clean) of the documents in ``held``: the spans of their terms, and the text with all its spans replaced."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), common.text_hash().alias("__h"))
    own = base.select("doc_id", "__h", F.struct(*KINDS[:4]).alias("own")).join(held.select("__id", "__g"), same_row())
    own = own.groupBy("__id", "__g").agg(F.first("own").alias("own")).select(F.col("__id").alias("__i"), F.col("__g").alias("__f"), "own.*")
    j = d.join(held, same_row()).groupBy("__id", "__g").agg(F.first("t").alias("t"), F.first("terms").alias("terms"))
    j = j.join(own, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__g") == F.col("__f"))).select("__id", "__g", "t", "terms", *KINDS[:4])
    # a term is a whole word of letters and digits, so the words' places are found by splitting once
    j = common.fixed(j, words=common.spans(F.col("t"), r"[\p{L}\p{N}]++"), items=F.array_sort(base_items()))
    j = common.fixed(j, found=F.filter("words", lambda x: F.array_contains(F.col("terms"), x["m"]))).drop("words")
    # a term inside a base span is that span already
    clear = F.filter("found", lambda x: ~F.exists("items", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    j = common.fixed(j, term=F.transform(clear, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    j = common.fixed(j, every=F.array_sort(F.concat("items", common.kinded(F.col("term"), 4))), cut=common.pieces(F.col("t"), REACH))
    return j.select("__id", "__g", "term", cleaned(F.col("t"), F.col("cut"), F.col("every")).alias("clean"))


def same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__g"))


def cleaned(text: Column, cut: Column, items: Column, chunk: int = 256) -> Column:
    """The text with its spans (array<struct<s, k, e>> in order) replaced; spans that overlap become one, named by the first.
    ``cut``: the text's ``pieces``.  ``items`` and ``cut`` are columns; the work is in proportion to the text and the spans: each span gives
    what stands before it and its name, chunk by chunk, and the strings are joined once."""
    names = F.array(*[F.lit(x) for x in ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")])
    size = common.PIECE

    def between(low: Column, high: Column) -> Column:
        a, b = F.floor(low / size).cast("int"), F.floor(high / size).cast("int")
        whole = F.array_join(F.transform(F.slice(cut, a + 2, F.greatest(b - a - 1, F.lit(0))), lambda x: F.left(x, F.lit(size))), "")
        apart = F.concat(F.substr(F.left(F.get(cut, a), F.lit(size)), low - a * size + 1, F.lit(size)), whole, F.substr(F.get(cut, b), F.lit(1), high - b * size))
        return F.when(high <= low, "").when(a == b, F.substr(F.get(cut, a), low - a * size + 1, high - low)).otherwise(apart)

    def put(x: Column) -> Column:
        own = between(x["s"], F.least(x["e"], x["s"] + 64))
        return F.when(x["k"] < 4, F.element_at(names, F.least(x["k"], F.lit(3)) + 1)).when(own.rlike("[0-9]"), "[NUMBER]").when(own.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[...]")

    last = F.floor((F.size(items) - 1) / chunk).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * chunk + 1, F.lit(chunk)))
    # the end of all spans before each chunk
    tops = F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), F.array_max(F.transform(c, lambda x: x["e"]))))))

    def step(acc, x):
        text_before = F.when(x["s"] >= acc["at"], F.concat(between(acc["at"], x["s"]), put(x))).otherwise("")
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], F.array(text_before)).alias("out"))

    def inside(c, at):
        return F.aggregate(c, F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.array_join(acc["out"], ""))

    body = F.array_join(F.zip_with(chunks, F.slice(tops, F.lit(1), F.size(chunks)), inside), "")
    return F.when(F.size(items) == 0, text).otherwise(F.concat(body, between(F.array_max(F.transform(items, lambda x: x["e"])), F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, n_term, base and spans (kind:start:end,
    comma-joined), sanitised (the text with its spans replaced; null where nothing is to be replaced)."""
    base = common.table(base_rows(docs), "pii-base")
    terms = common.table(disclosing_terms(docs, base), "pii-terms")
    if terms.isEmpty():
        d = base.withColumn("term", F.lit(None)).withColumn("__clean", F.lit(None).cast("string"))
    else:
        # few documents hold a disclosing term: as tables their sizes are known, so that their join need not move all texts
        held = common.table(holders(docs, terms), "pii-holders")
        more = common.table(term_rows(docs, base, held), "pii-term-rows").withColumnRenamed("clean", "__clean")
        d = base.join(more, same_row(), "left")
    d = d.withColumn("term", F.coalesce(F.col("term").cast("array<struct<s:int,e:int>>"), F.array().cast("array<struct<s:int,e:int>>")))
    own = base_items()
    every = F.concat(own, common.kinded(F.col("term"), 4))
    return d.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], common.span_text(own, KINDS).alias("base"),
                    common.span_text(every, KINDS).alias("spans"), F.coalesce("__clean", "clean").alias("sanitised"))
