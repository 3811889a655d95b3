"""Personal data: patterns, and terms that reveal protected entities by co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, packed, stored, whole_text

#: Fixed patterns. Possessive repeats and the look-behinds keep the scan linear; a match may
#: also start where the one before it ended, so the matches are the leftmost non-overlapping ones.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}+"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
_IP_PARTS = "^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\\.|$)){4}$"

TERM = "\\p{L}{3,}"
#: Share of an entity's information that a term must carry to be removed, or generalised.
REMOVE_AT = 0.9
GENERALISE_AT = 0.8
#: Different texts in which a term must stand with an entity; one text may be chance or a copy.
LEAST_CONTEXTS = 3
_RUN = 256


def running_starts(lengths: Column) -> Column:
    """Sum of the elements before each one, in runs so that long arrays stay cheap."""

    def sums_before(values: Column, start: Column) -> Column:
        zero = F.struct(start.cast("long").alias("total"), F.array().cast("array<bigint>").alias("seen"))
        return F.aggregate(
            values,
            zero,
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"), F.concat(acc["seen"], F.array(acc["total"])).alias("seen")
            ),
            lambda acc: acc["seen"],
        )

    def in_runs(values: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _RUN).cast("int")),
            lambda k: F.slice(values, k * _RUN + 1, F.lit(_RUN)),
        )
        totals = F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda acc, x: acc + x))
        return F.flatten(F.zip_with(runs, sums_before(totals, F.lit(0)), sums_before))

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(lengths, in_runs))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the non-overlapping matches, in code points, end exclusive.

    Positions follow from the lengths of the matches and of the pieces between them.
    """

    def placed(hits: Column) -> Column:
        return let(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)),
            lambda pieces: F.zip_with(
                F.zip_with(pieces, running_starts(_steps(pieces, hits)), lambda p, b: F.length(p) + b),
                hits,
                lambda s, h: F.struct(
                    s.cast("long").alias("start"), (s + F.length(h)).cast("long").alias("end"), h.alias("value")
                ),
            ),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: F.when(F.size(hits) == 0, none).otherwise(placed(hits)),
    )


def _steps(pieces: Column, hits: Column) -> Column:
    return F.zip_with(pieces, hits, lambda p, h: (F.length(p) + F.length(h)).cast("long"))


def base_spans(text: Column) -> Column:
    """Spans (kind, start, end, value) of e-mail addresses, IPs, cards and phones, in this order.

    A match that fails its test is dropped, without another try inside it.
    """

    def digits(value: Column) -> Column:
        return F.regexp_replace(value, "[^0-9]", "")

    def card(value: Column) -> Column:
        return F.length(digits(value)).between(16, 19) & F.call_function("luhn_check", digits(value))

    found = {
        "email": (text.contains("@"), EMAIL, None),
        "ip": (text.rlike("[0-9]\\.[0-9]"), IP, lambda v: v.rlike(_IP_PARTS)),
        "card": (text.rlike("[0-9][\\x20-]?[0-9]"), CARD, card),
        "phone": (text.contains("+"), PHONE, lambda v: F.length(digits(v)).between(8, 15)),
    }
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")
    parts = []
    for kind in KINDS:
        possible, pattern, test = found[kind]
        hits = matches(text, pattern)
        if test is not None:
            hits = F.filter(hits, _on_value(test))
        parts.append(F.when(possible, F.transform(hits, _as_kind(kind))).otherwise(none))
    return F.concat(*parts)


def _on_value(test):
    return lambda m: test(m["value"])


def _as_kind(kind: str):
    return lambda m: F.struct(
        F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _terms(text: Column) -> Column:
    """The different terms of a text, each in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.lower(t)))


def protected(span: Column) -> Column:
    """What a span protects: its value, and the class of values that it belongs to.

    A single value is too rare for counts in most corpora; the domain of an address, the
    network of an IP, the issuer of a card and the country code of a phone are not.
    """
    value = F.lower(span["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    group = (
        F.when(span["kind"] == "email", F.substring_index(value, "@", -1))
        .when(span["kind"] == "ip", F.substring_index(value, ".", 3))
        .when(span["kind"] == "card", F.substring(digits, 1, 6))
        .otherwise(F.substring(digits, 1, 2))
    )
    return F.array(F.concat_ws(":", span["kind"], value), F.concat_ws(":", span["kind"], F.lit("class"), group))


def _apart(base: DataFrame, added: DataFrame, doc_key: list[str]) -> DataFrame:
    """Rows of ``added`` that overlap no span of ``base`` of their document.

    Both are sorted by start within a document: a span overlaps if one that starts before
    ends after its start, or the next one starts before its end.
    """
    both = base.select(*doc_key, F.lit(None).cast("string").alias("kind"), "start", "end", F.lit(None).cast("string").alias("value"))
    both = both.unionByName(added)
    upto = W.partitionBy(*doc_key).orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    onward = W.partitionBy(*doc_key).orderBy("start").rangeBetween(W.currentRow, W.unboundedFollowing)
    is_base = F.col("kind").isNull()
    met = both.withColumn("before", F.max(F.when(is_base, F.col("end"))).over(upto)).withColumn(
        "after", F.min(F.when(is_base, F.col("start"))).over(onward)
    )
    overlaps = (F.col("before") > F.col("start")) | (F.col("after") < F.col("end"))
    return met.filter(~is_base & ~F.coalesce(overlaps, F.lit(False))).drop("before", "after")


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = False,
    least_contexts: int = LEAST_CONTEXTS,
    remove_at: float = REMOVE_AT,
    generalise_at: float = GENERALISE_AT,
) -> DataFrame:
    """``doc`` (the row as a struct, without its text unless ``keep_text``), ``base`` and ``spans``.

    ``base`` holds the spans of the patterns. Their values are the protected
    entities, and so are the classes of values that :func:`protected` names: a term that
    tells the domain of an address tells something of every address there. For an entity e and a term t of a document with e, wherever it
    stands, corpus counts of documents give P(e), P(t) and P(e, t); the
    disclosure of e by t is the pointwise mutual information over the
    information of e:

        log2(P(e, t) / (P(e) P(t))) / -log2 P(e)

    It is 1 where t never occurs without e. A term is telling if its disclosure
    of some entity is ``generalise_at`` or above and the two stand together in
    ``least_contexts`` different texts. Every occurrence of a telling term in
    every document with personal data is a span, unless it overlaps one of
    ``base``: of kind ``term`` from ``remove_at`` on, else of kind ``hint``.
    ``spans`` is ``base`` and these, by kind, then start. Documents without
    personal data are never changed.

    Entities without terms: those found in fewer than ``least_contexts``
    different texts, and those found in every document, which have no
    information. Texts that differ at all are different, near copies too.

    All counts cover the whole corpus and whole texts: words are counted once per
    document and pre-aggregated per task. Pairs are only built for entities and
    terms whose own counts allow a telling pair. Every join has one row per key on
    its small side, apart from the one by document, and is split where a key is hot.

    Defined cases: a null text is empty and has no spans. Every row is a document
    in all counts, repeated rows too; rows are told apart by id and text, so
    repeated rows of both get the same spans. A null id is one more id. Empty
    tables give an empty result. Extra columns stay in ``doc``. Very long texts
    are searched whole.
    """
    rows = packed(docs).select(
        F.col("doc") if keep_text or len(docs.columns) == 1 else F.col("doc").dropFields(f"`{text_col}`").alias("doc"),
        F.xxhash64(F.lit("id"), F.col("doc").getField(id_col)).alias("id_hash"),
        whole_text(f"doc.`{text_col}`").alias("text"),
    )
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    based = rows.withColumn("base", base_spans(F.col("text")))
    # Only documents with personal data keep their text here.
    marked = stored(based.withColumn("text", F.when(F.size("base") > 0, F.col("text"))), "pii-spans")
    held = marked.filter(F.size("base") > 0)
    doc_key = ["id_hash", "text_hash"]
    entities = F.array_distinct(F.flatten(F.transform("base", protected)))
    owners = held.select(*doc_key, F.explode(entities).alias("entity")).groupBy("entity", *doc_key).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    of_entity = (
        owners.groupBy("entity")
        .agg(F.sum("n_rows").alias("n_entity"), F.count_distinct("text_hash").alias("n_texts"))
        .filter(F.col("n_texts") >= least_contexts)
        .drop("n_texts")
    )
    known = stored(owners.join(of_entity, "entity"), "pii-entities")
    said = (
        held.join(known.select(*doc_key).distinct(), doc_key, "left_semi")
        .select(*doc_key, F.explode(_terms(F.col("text"))).alias("term"))
        .distinct()
    )
    of_term = (
        rows.select(F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
        .filter(F.col("n_term") >= least_contexts)
    )
    n_all = F.lit(marked.count()).cast("double")

    def disclosure(n_both: Column) -> Column:
        apart = F.col("n_entity").cast("double") * F.col("n_term")
        return F.try_divide(F.log2(n_both * n_all / apart), F.log2(n_all / F.col("n_entity")))

    together = (
        said.join(of_term, "term")
        .join(known, doc_key)
        .filter(disclosure(F.least("n_entity", "n_term")) >= generalise_at)
        .groupBy("entity", "term", "n_entity", "n_term")
        .agg(F.sum("n_rows").alias("n_both"), F.count_distinct("text_hash").alias("n_texts"))
        .filter(F.col("n_texts") >= least_contexts)
    )
    telling = stored(
        together.groupBy("term")
        .agg(F.max(disclosure(F.col("n_both"))).alias("disclosure"))
        .filter(F.col("disclosure") >= generalise_at)
        .select("term", F.when(F.col("disclosure") >= remove_at, "term").otherwise("hint").alias("kind")),
        "pii-terms",
    )
    placed = (
        held.select(*doc_key, F.explode(matches(F.col("text"), TERM)).alias("at"))
        .withColumn("term", F.lower("at.value"))
        .join(telling, "term")
        .select(*doc_key, "kind", "at.start", "at.end", F.col("term").alias("value"))
        .distinct()
    )
    standing = held.select(*doc_key, F.explode("base").alias("at")).select(*doc_key, "at.start", "at.end")
    added = _apart(standing, placed, doc_key).groupBy(*doc_key).agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("added")
    )
    return marked.join(added, doc_key, "left").select(
        "doc",
        "base",
        F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added")).alias("spans"),
    )


def sanitised(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with personal data taken out.

    ``found`` comes from :func:`find_personal_data` with ``keep_text``. Patterns
    and hints are generalised to their kind in angle brackets, telling terms are
    removed. Where spans overlap, the first one stands.
    """
    text = whole_text(f"doc.`{text_col}`")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def step(acc, s):
        piece = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        mark = F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        return F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(piece, mark)).alias("out"))
        )

    clean = F.aggregate(
        ordered, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    )
    replaced = F.when(F.size("spans") == 0, F.col("doc").getField(text_col)).otherwise(clean)
    return found.select(
        *[(replaced if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
