"""Personal data and information-theoretic sanitisation. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import keyed, staged

#: Kinds in the order in which they are listed, and patterns that find the same spans as those of the contract
#: but never try a run of characters twice: a run that fails from its first character fails from every other.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"[\p{L}\p{N}]+"

_SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    backwards = F.reverse(digits)

    def digit(i):
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.element_at(doubled, d + 1)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + digit(i)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def located(text: Column, pattern: str, kind: int, valid, base: Column | int = 0) -> Column:
    """Matches that are valid as spans, in code points from `base`; the pieces between matches give the places."""
    base = F.lit(base).cast("int") if isinstance(base, int) else base.cast("int")
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda b, m: F.struct(b.alias("b"), m.alias("m")))
    none = F.from_json(F.lit("[]"), _SPAN)

    def step(a, x):
        start = a["at"] + F.length(x["b"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["m"].isNotNull() & valid(x["m"]), F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.aggregate(pieces, F.struct(base.alias("at"), none.alias("out")), step, lambda a: a["out"])


def base_spans(text: Column) -> Column:
    found = []
    for k, kind in enumerate(KINDS[:4]):
        spans = located(text, PATTERNS[kind], k, lambda m, kind=kind: _valid(kind, m))
        hint = F.contains(text, F.lit(HINT[kind])) if HINT[kind] else F.regexp_like(text, F.lit("[0-9][0-9 -]{12}"))
        found.append(F.when(hint, spans).otherwise(F.from_json(F.lit("[]"), _SPAN)))
    return F.array_sort(F.concat(*found))


def written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined. Spans are already in that order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(spans: Column) -> Column:
    """By start, then kind as listed."""
    by = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.transform(F.array_sort(by), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))


def entity(span: Column) -> Column:
    """What a span protects: the kind with the address in lower case or the digits alone."""
    value = F.when(span["kind"] >= 2, _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"].cast("string"), value)


def _outside(text: Column) -> Column:
    """The text with each character of a span replaced by one that is no letter, so that places stay as they are."""

    def step(a, s):
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        hidden = F.repeat(F.lit("\ue000"), F.greatest(s["end"] - F.greatest(a["at"], s["start"]), F.lit(0)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, hidden).alias("out"))

    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size("spans") > 0, F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)).otherwise(text)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosing_terms(found: DataFrame, min_support: int, generalise: float, remove: float, most_terms: int) -> DataFrame:
    """doc_id, th, term, action: the terms of each document that reveal an entity which the same document holds.

    Terms and entities meet wherever one document has both. share = PMI(entity; term) / -log2 p(entity), at most 1,
    reached when the term occurs in no other document. A pair needs min_support documents; one that rests on fewer
    says nothing. As a pair is in no more documents than its entity, share >= generalise bounds the documents of the
    term: commoner terms are left out before pairs are made, which changes no result.
    """
    n_docs = float(found.count())
    held = found.where(F.size("spans") > 0).select("doc_id", "th", F.explode(F.transform("spans", entity)).alias("entity")).distinct()
    df_entity = held.groupBy("entity").agg(F.count("*").alias("df_entity")).where((F.col("df_entity") >= min_support) & (F.col("df_entity") < n_docs))
    upto = F.pow(F.lit(n_docs), F.lit(1 - generalise)) * F.pow(F.col("df_entity"), F.lit(generalise)) * (1 + 1e-9)
    held = staged(held.join(df_entity, "entity").withColumn("upto", upto))
    most = held.agg(F.max("upto")).first()[0] or 0.0
    df_term = found.select(F.explode(_terms(F.col("body"))).alias("term")).groupBy("term").agg(F.count("*").alias("df_term"))
    df_term = staged(df_term.where(F.col("df_term").between(min_support, most)))
    if df_term.count() <= most_terms:  # a checked size; beyond it the sides are dealt by term
        df_term = F.broadcast(df_term)
    words = found.where(F.size("spans") > 0).select("doc_id", "th", F.explode(_terms(F.col("body"))).alias("term")).distinct().join(df_term, "term")
    w, h = words.alias("w"), held.alias("h")
    same = F.col("w.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("w.th") == F.col("h.th")) & (F.col("df_term") <= F.col("upto"))
    met = staged(w.join(h, same).select("w.doc_id", "w.th", "entity", "term", "df_entity", "df_term"))
    pairs = met.groupBy("entity", "term", "df_entity", "df_term").agg(F.count("*").alias("together")).where(F.col("together") >= min_support)
    n = F.lit(n_docs)
    share = F.log2(F.col("together") * n / F.col("df_entity") / F.col("df_term")) / F.log2(n / F.col("df_entity"))
    pairs = pairs.withColumn("share", share).where(F.col("share") >= generalise).select("entity", "term", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))
    return met.join(pairs, ["entity", "term"]).groupBy("doc_id", "th", "term").agg(F.max("action").alias("action"))


def find_personal_data(docs: DataFrame, min_support: int = 3, generalise: float = 0.7, remove: float = 0.9, most_terms: int = 100_000) -> DataFrame:
    """One row per row of `docs`: doc_id, th, base (spans by pattern), spans (base and disclosing terms).

    Null text counts as empty and has no span. Rows that share a doc_id are told apart by their text; identical
    rows get identical spans. Other columns of `docs` are ignored, whatever their names. No rows give no rows.
    A document without a protected entity is never changed: terms count only with an entity they reveal, in every
    document that holds it, and there at all their places outside the spans.
    """
    found = staged(keyed(docs).withColumn("spans", base_spans(F.col("text"))).select("doc_id", "th", "spans", _outside(F.col("text")).alias("body")))
    terms = disclosing_terms(found, min_support, generalise, remove, most_terms)
    marks = terms.groupBy("doc_id", "th").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("marks"))
    f, a = found.alias("f"), marks.alias("a")
    on = F.col("f.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("f.th") == F.col("a.th"))
    action = lambda value: F.element_at("marks", F.lower(value))
    places = located(F.col("body"), TERM, 4, lambda m: action(m).isNotNull())
    added = F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), action(s["value"]).alias("value")))
    nil = F.from_json(F.lit("[]"), _SPAN)
    own = f.join(a, on, "left").select("f.doc_id", "f.th", in_order(F.col("spans")).alias("base"), F.when(F.col("marks").isNotNull(), added).otherwise(nil).alias("added"))
    return own.select("doc_id", "th", "base", in_order(F.concat("base", "added")).alias("spans"))


def general_class(term: Column) -> Column:
    """What a term is generalised to: numbers by how many digits they have, mixed terms, capitalised ones, other words."""
    digits = F.concat(F.lit("[NUMBER OF "), F.length(term).cast("string"), F.lit(" DIGITS]"))
    capital = F.regexp_like(term, F.lit(r"^\p{Lu}"))
    return F.when(F.regexp_like(term, F.lit(r"^\p{N}+$")), digits).when(F.regexp_like(term, F.lit(r"\p{N}")), "[CODE]").when(capital, "[NAME]").otherwise("[WORD]")


def sanitised(docs: DataFrame, **parameters) -> DataFrame:
    """`docs` with each span of personal data replaced by its kind, revealing terms by their class or, if they tell too much, nothing.

    All columns of `docs` stay; text is rewritten, and n_chars where there is one.
    """
    found = find_personal_data(docs, **parameters).where(F.size("spans") > 0).select("doc_id", "th", "spans").distinct()
    label = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # Columns of docs travel as one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("body")).withColumn("key", F.xxhash64("body"))
    joined = rows.join(found, rows["id"].eqNullSafe(found["doc_id"]) & (rows["key"] == found["th"]), "left")

    def step(a, s):
        place = F.when(s["kind"] < 4, F.element_at(label, s["kind"] + 1)).when(s["value"] == "remove", "").otherwise(general_class(F.substring("body", s["start"] + 1, s["end"] - s["start"])))
        gap = F.when(s["start"] >= a["at"], F.concat(F.substring("body", a["at"] + 1, s["start"] - a["at"]), place)).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap).alias("out"))

    rest = lambda a: F.concat(a["out"], F.substring("body", a["at"] + 1, F.length("body")))
    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    text = F.when(F.col("spans").isNotNull(), clean).otherwise(F.col("row.text"))
    out = joined.select("row", F.col("spans").isNotNull().alias("changed"), text.alias("clean"))
    length = F.when(F.col("changed"), F.length("clean").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("clean"), "n_chars": length}
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the span lists written out."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
