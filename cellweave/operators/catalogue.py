"""The catalogue of annotated columns: nested records to triples and back.

Records are rows ``subject, column_id, record`` with the nested schema of ``model.RECORD``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from .. import vocab as V
from ..functions import terms
from ..model import IRI, LITERAL, MAPPING, REFERENCE, TRIPLES, triple
from .hot import split_groups
from .identifiers import unique_identifiers
from .prefixes import compact, compact_by_table, expand

# Entries of one record or node that are gathered into one row.
ENTRIES_PER_PART = 10_000


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in pairs.items() for text in pair])


def with_subjects(records: DataFrame, order_by: str, base: str = V.CATALOGUE_BASE) -> DataFrame:
    """Add ``subject``, the record's unique IRI, from ``column_id`` in the given order."""
    named = unique_identifiers(records, "column_id", order_by, "_identifier")
    return named.withColumn("subject", F.concat(F.lit(base), F.col("_identifier"))).drop("_identifier")


# --- nested -> triples: arrays of triples inside each record ---------------------------------------------------


def core_triples(base: str = V.CATALOGUE_BASE) -> Column:
    """Type, name, label, description and datatype; what a record lacks gives no triple."""
    subject, record = F.col("subject"), F.col("record")
    candidates = F.array(
        triple(subject, V.RDF_TYPE, base + "ColumnAnnotation", IRI),
        triple(subject, base + "columnName", F.col("column_id")),
        triple(subject, V.LABEL, record["label"]),
        triple(subject, V.DESCRIPTION, record["description"]),
        triple(subject, base + "dataType", terms.datatype_iri(record["data_type"]), IRI),
    )
    return F.filter(candidates, lambda t: t["o"].isNotNull())


def mapping_triples(prefixes: dict[str, str] | Column) -> Column:
    """One triple per mapping; no relation means related, unknown relations are left out."""
    predicates = _literal_map(V.RELATION_PREDICATES)

    def predicate(mapping: Column) -> Column:
        return F.try_element_at(predicates, F.coalesce(mapping["relation"], F.lit(V.DEFAULT_RELATION)))

    known = F.filter(
        F.col("record.mappings"), lambda m: m["property"].isNotNull() & predicate(m).isNotNull()
    )
    return F.transform(known, lambda m: triple(F.col("subject"), predicate(m), expand(m["property"], prefixes), IRI))


def reference_triples() -> Column:
    """seeAlso for urls, sameAs for wikidata ids; a reference may have both."""
    references = F.col("record.references")
    urls = F.filter(references, lambda r: r["url"].isNotNull())
    items = F.filter(references, lambda r: r["wikidata"].isNotNull())
    return F.concat(
        F.transform(urls, lambda r: triple(F.col("subject"), V.SEE_ALSO, r["url"], IRI)),
        F.transform(
            items,
            lambda r: triple(F.col("subject"), V.SAME_AS, F.concat(F.lit(V.WIKIDATA_ENTITY), r["wikidata"]), IRI),
        ),
    )


def comment_triples() -> Column:
    comments = F.filter(F.col("record.comments"), lambda c: c.isNotNull())
    return F.transform(comments, lambda c: triple(F.col("subject"), V.COMMENT, c))


def extra_triples(base: str = V.CATALOGUE_BASE) -> Column:
    """One triple per value of every further field, with a predicate in the catalogue's namespace."""
    entries = F.filter(F.map_entries("record.extras"), lambda e: ~e["key"].isin(*V.RECORD_FIELDS))

    def values(entry: Column) -> Column:
        kept = F.filter(entry["value"], lambda v: v.isNotNull())
        return F.transform(kept, lambda v: triple(F.col("subject"), F.concat(F.lit(base), entry["key"]), v))

    return F.flatten(F.transform(entries, values))


def _lay_out_arrays(records: DataFrame, arrays: list[Column]) -> DataFrame:
    present = [F.coalesce(a, F.array().cast(T.ArrayType(TRIPLES))) for a in arrays]
    # Subjects are unique, so equal triples can only meet inside one record.
    return records.select(F.inline(F.array_distinct(F.concat(*present))))


def record_triples(
    records: DataFrame, prefixes: dict[str, str] | Column, parts: tuple[str, ...] | None = None,
    base: str = V.CATALOGUE_BASE,
) -> DataFrame:
    """Triples of all records in one narrow pass. ``parts`` picks among core, mappings, references,
    comments and extras; the default is all."""
    arrays = {
        "core": lambda: core_triples(base),
        "mappings": lambda: mapping_triples(prefixes),
        "references": reference_triples,
        "comments": comment_triples,
        "extras": lambda: extra_triples(base),
    }
    return _lay_out_arrays(records, [arrays[p]() for p in (parts or tuple(arrays))])


def vocabulary_triples(spark: SparkSession, base: str = V.CATALOGUE_BASE) -> DataFrame:
    """Definitions of the annotation class and its two properties."""
    # Labels and comment of the definitions.
    annotation, name, data_type = base + "ColumnAnnotation", base + "columnName", base + "dataType"
    rows = [
        (annotation, V.RDF_TYPE, V.RDFS + "Class", IRI),
        (annotation, V.LABEL, "Column Annotation", LITERAL),
        (annotation, V.COMMENT, V.CLASS_COMMENT, LITERAL),
        (name, V.RDF_TYPE, V.RDF + "Property", IRI),
        (name, V.LABEL, "column name", LITERAL),
        (name, V.RDFS + "domain", annotation, IRI),
        (data_type, V.RDF_TYPE, V.RDF + "Property", IRI),
        (data_type, V.LABEL, "data type", LITERAL),
        (data_type, V.RDFS + "domain", annotation, IRI),
    ]
    return spark.createDataFrame([(*r, None, None) for r in rows], TRIPLES)


def dataset_triples(
    metadata: DataFrame, subject: Column | None = None, fields: str = "metadata", base: str = V.CATALOGUE_BASE
) -> DataFrame:
    """Triples of dataset metadata maps, one dataset per row; five keys have predicates of their own."""
    subject = subject if subject is not None else F.lit(base + "Dataset")
    predicates = _literal_map({key: p for key, (p, _) in V.DATASET_KEYS.items()})
    iri_keys = [key for key, (_, kind) in V.DATASET_KEYS.items() if kind == IRI]
    rows = metadata.select(subject.alias("_subject"), F.col(fields).alias("_fields"))

    def one(entry: Column) -> Column:
        predicate = F.coalesce(F.try_element_at(predicates, entry["key"]), F.concat(F.lit(base), entry["key"]))
        kind = F.when(entry["key"].isin(iri_keys), F.lit(IRI)).otherwise(F.lit(LITERAL))
        return triple(F.col("_subject"), predicate, entry["value"], kind)

    entries = F.filter(F.map_entries("_fields"), lambda e: e["value"].isNotNull())
    typed = F.array(triple(F.col("_subject"), V.RDF_TYPE, V.DCAT + "Dataset", IRI))
    return rows.select(F.inline(F.concat(typed, F.transform(entries, one))))


def file_triples(
    metadata: DataFrame, subject: Column | None = None, fields: str = "metadata", base: str = V.CATALOGUE_BASE
) -> DataFrame:
    """Created, modified and version of a catalogue file; other keys are ignored. The subject is the file, ``<>``."""
    subject = subject if subject is not None else F.lit("")
    rows = metadata.select(subject.alias("_subject"), F.col(fields).alias("_fields"))
    value = lambda key: F.try_element_at(F.col("_fields"), F.lit(key))
    date = V.XSD + "date"
    found = F.filter(
        F.array(
            triple(F.col("_subject"), V.DCTERMS + "created", value("created"), datatype=date),
            triple(F.col("_subject"), V.DCTERMS + "modified", value("modified"), datatype=date),
            triple(F.col("_subject"), base + "version", value("version")),
        ),
        lambda t: t["o"].isNotNull(),
    )
    return rows.select(F.inline(found))


# --- triples -> nested ------------------------------------------------------------------------------------------


def _relation_codes(predicate: Column) -> Column:
    """Relation codes that a predicate stands for; null for other predicates."""
    inverse: dict[str, list[str]] = {}
    for relation, iri in V.RELATION_PREDICATES.items():
        inverse.setdefault(iri, []).append(relation)
    pairs = [x for iri, codes in inverse.items() for x in (F.lit(iri), F.array(*[F.lit(c) for c in codes]))]
    return F.try_element_at(F.create_map(*pairs), predicate)


def relations_of(triples: DataFrame) -> DataFrame:
    """Relations that an IRI-valued triple stands for: ``s, relation, o``; a predicate can mean several."""
    predicates = sorted(set(V.RELATION_PREDICATES.values()))
    related = triples.filter(F.col("p").isin(predicates) & (F.col("o_kind") == IRI))
    return related.select("s", F.explode(_relation_codes(F.col("p"))).alias("relation"), "o")


def _reference_fields() -> tuple[Column, Column]:
    """Url and wikidata id that a triple refers to, each null where it does not."""
    related = F.col("p").isin(sorted(set(V.RELATION_PREDICATES.values()) | {V.SAME_AS})) & (F.col("o_kind") == IRI)
    url = F.when(related & (F.col("p") == V.SEE_ALSO), F.col("o"))
    wikidata = F.when(related & F.col("o").startswith(V.WIKIDATA_ENTITY), terms.last_segment("o"))
    return url, wikidata


def references_of(triples: DataFrame) -> DataFrame:
    """References of each subject: ``s, url, wikidata``, each once.

    Wikidata entities named by any relation or by sameAs give their id; every seeAlso IRI gives its url.
    """
    url, wikidata = _reference_fields()
    none = F.lit(None).cast("string")
    both = F.array(
        F.struct(none.alias("url"), wikidata.alias("wikidata")), F.struct(url.alias("url"), none.alias("wikidata"))
    )
    listed = F.filter(both, lambda r: r["url"].isNotNull() | r["wikidata"].isNotNull())
    return triples.select("s", F.inline(listed)).distinct()


def first_values(triples: DataFrame) -> DataFrame:
    """First and last object per subject and property, by the objects' own order: ``s, p, first_o, last_o``."""
    return triples.groupBy("s", "p").agg(F.min("o").alias("first_o"), F.max("o").alias("last_o"))


def annotation_entries(
    triples: DataFrame, prefixes: dict[str, str] | DataFrame, base: str = V.CATALOGUE_BASE
) -> DataFrame:
    """The catalogue in long form: ``s, field, key, value``, one row per entry of an annotation record.

    Fields are name, label, description, data_type (one row each), mapping (key: relation), url, wikidata,
    comment and extra (key: property name, first value only). An extra may be called like a field; :func:`regroup` decides then.
    """
    is_class = (F.col("p") == V.RDF_TYPE) & (F.col("o") == base + "ColumnAnnotation")
    is_name = F.col("p") == base + "columnName"
    known = triples.filter(is_class | is_name).groupBy("s").agg(
        F.bool_or(is_class).alias("_class"), F.bool_or(is_name).alias("_name")
    )
    about = triples.join(known.filter(F.col("_class") & F.col("_name")), "s", "left_semi")

    by_table = isinstance(prefixes, DataFrame)
    none = F.lit(None).cast("string")
    o, local = F.col("o"), terms.local_name("p", base)
    own_fields = ("columnName", "semanticType", "dataType")
    pick = {base + "columnName": "name", V.LABEL: "label", V.DESCRIPTION: "description"}
    url, wikidata = _reference_fields()

    def entry(field: Column | str, key: Column, value: Column) -> Column:
        field = F.lit(field) if isinstance(field, str) else field
        return F.struct(field.alias("field"), key.alias("key"), value.alias("value"))

    is_mapping = (F.col("o_kind") == IRI) & ~o.startswith(V.WIKIDATA_ENTITY)
    short = o if by_table else compact(o, prefixes)
    mappings = F.transform(
        F.when(is_mapping, _relation_codes(F.col("p"))), lambda code: entry("mapping", code, short)
    )
    others = F.array(
        entry(F.try_element_at(_literal_map(pick), F.col("p")), none, o),
        entry("data_type", none, F.when(F.col("p") == base + "dataType", terms.datatype_code("o"))),
        entry(F.when(~local.isin(*own_fields), F.lit("extra")), local, o),
        entry("url", none, url),
        entry("wikidata", none, wikidata),
        entry("comment", none, F.when((F.col("p") == V.COMMENT) & (o != V.CLASS_COMMENT), o)),
    )
    others = F.filter(others, lambda e: e["field"].isNotNull() & e["value"].isNotNull())
    no_mappings = F.array().cast(T.ArrayType(T.StructType(
        [T.StructField(n, T.StringType()) for n in ("field", "key", "value")]
    )))
    entries = about.select("s", F.inline(F.concat(others, F.coalesce(mappings, no_mappings))))

    # One pass settles both kinds of fields: lists keep each value once, the others keep one value.
    is_list = F.col("field").isin("mapping", "url", "wikidata", "comment")
    grouped = entries.groupBy("s", "field", "key", F.when(is_list, F.col("value")).alias("_value")).agg(
        F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    low = F.col("field").isin("name", "extra")
    result = grouped.select("s", "field", "key", F.when(low, F.col("_low")).otherwise(F.col("_high")).alias("value"))
    if not by_table:
        return result
    mapped = compact_by_table(result.filter(F.col("field") == "mapping"), "value", prefixes, "_short")
    mapped = mapped.select("s", "field", "key", F.col("_short").alias("value"))
    return result.filter(F.col("field") != "mapping").unionByName(mapped)


def regroup(entries: DataFrame, limit: int = ENTRIES_PER_PART) -> DataFrame:
    """Nested records from the long form: ``subject, column_name, record``, one per subject. Fields without entries are null.

    Subjects of more than ``limit`` entries are gathered in parts, by several tasks, and the parts are put together. A property in the
    catalogue's own namespace that is called like a field stands for that field where there is no other. Mappings cannot be told by
    one; it stays an extra where there are none.
    """
    # Entries come from several joins; they are worked out once for counting and gathering.
    parted = split_groups(session.settle(entries), "s", ["field", "key", "value"], limit)

    def one(name: str) -> Column:
        return F.max(F.when(F.col("field") == name, F.col("value"))).alias(name)

    def many(name: str, entry: Column, *fields: str) -> Column:
        return F.collect_list(F.when(F.col("field").isin(*fields), entry)).alias(name)

    mapping = F.struct(F.col("value").alias("property"), F.col("key").alias("relation")).cast(MAPPING)
    reference = F.struct(
        F.when(F.col("field") == "url", F.col("value")).alias("url"),
        F.when(F.col("field") == "wikidata", F.col("value")).alias("wikidata"),
    ).cast(REFERENCE)
    singles = ("name", "label", "description", "data_type")
    lists = ("mappings", "references", "comments", "extras")
    partial = parted.groupBy(F.col("s").alias("subject"), "part").agg(
        *map(one, singles), many("mappings", mapping, "mapping"), many("references", reference, "url", "wikidata"),
        many("comments", F.col("value"), "comment"), many("extras", F.struct("key", F.array("value").alias("value")), "extra"),
    )
    whole = partial.groupBy("subject").agg(
        *[F.max(c).alias(c) for c in singles], *[F.sort_array(F.flatten(F.collect_list(c))).alias(c) for c in lists]
    )
    whole = whole.withColumn("extras", F.map_from_entries("extras"))
    named = lambda c: F.try_element_at("extras", F.lit(c))
    listed = lambda c: F.when(F.size(c) > 0, F.col(c))
    plain = F.transform(named("references"), lambda x: F.struct(x.alias("url"), F.lit(None).cast("string").alias("wikidata")).cast(REFERENCE))
    told = F.when(F.size("mappings") > 0, F.array(*map(F.lit, (*_TOLD, "mappings")))).otherwise(F.array(*map(F.lit, _TOLD)))
    extras = F.map_filter("extras", lambda k, _: ~F.array_contains(told, k))
    return whole.select(
        "subject", F.col("name").alias("column_name"),
        F.struct(
            *[F.coalesce(c, named(c)[0]).alias(c) for c in ("label", "description", "data_type")],
            listed("mappings").alias("mappings"),
            F.coalesce(listed("references"), plain).alias("references"),
            F.coalesce(listed("comments"), named("comments")).alias("comments"),
            F.when(F.size(extras) > 0, extras).alias("extras"),
        ).alias("record"),
    )


# Fields that a property of the catalogue's namespace can stand for.
_TOLD = ("label", "description", "data_type", "references", "comments")


def dataset_metadata(triples: DataFrame, base: str = V.CATALOGUE_BASE) -> DataFrame:
    """Metadata of every dataset, one row per key: ``dataset, key, value``."""
    datasets = triples.filter((F.col("p") == V.RDF_TYPE) & (F.col("o") == V.DCAT + "Dataset")).select("s").distinct()
    keys = _literal_map({p: key for key, (p, _) in V.DATASET_KEYS.items()})
    key = F.coalesce(F.try_element_at(keys, F.col("p")), terms.local_name("p", base))
    rows = triples.join(datasets, "s", "left_semi").withColumn("key", key).filter(F.col("key").isNotNull())
    return rows.groupBy(F.col("s").alias("dataset"), "key").agg(F.max("o").alias("value"))


def file_metadata(triples: DataFrame, subject: str | None = "", base: str = V.CATALOGUE_BASE) -> DataFrame:
    """Created, modified and version of a catalogue file: ``key, value``; of all files, with their ``subject``, for None."""
    keys = {V.DCTERMS + "created": "created", V.DCTERMS + "modified": "modified", base + "version": "version"}
    about = triples.filter(F.col("p").isin(list(keys)))
    about = about if subject is None else about.filter(F.col("s") == subject)
    by = [F.col("s").alias("subject")] if subject is None else []
    return about.groupBy(*by, F.try_element_at(_literal_map(keys), F.col("p")).alias("key")).agg(F.max("o").alias("value"))


def _as_list(text: Column) -> Column:
    """The values of a JSON list, or of a single value."""
    items = F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    return F.when(text.isNotNull(), F.when(text.startswith("["), items).otherwise(F.array(text)))


def normalise_record(fields: Column) -> Column:
    """A record with the schema of ``model.RECORD`` from a map of field names to JSON texts."""
    def field(name: str) -> Column:
        return F.try_element_at(fields, F.lit(name))

    def reference(item: Column) -> Column:
        plain = F.struct(item.alias("url"), F.lit(None).cast("string").alias("wikidata"))
        return F.when(item.startswith("{"), F.from_json(item, REFERENCE)).otherwise(plain)

    own = F.map_filter(fields, lambda k, v: ~k.isin(*V.RECORD_FIELDS, "extras") & v.isNotNull())
    extras = F.coalesce(
        F.from_json(field("extras"), T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        F.transform_values(own, lambda _, v: _as_list(v)),
    )
    return F.struct(
        field("label").alias("label"),
        field("description").alias("description"),
        field("data_type").alias("data_type"),
        F.from_json(field("mappings"), T.ArrayType(MAPPING)).alias("mappings"),
        F.transform(_as_list(field("references")), reference).alias("references"),
        _as_list(field("comments")).alias("comments"),
        extras.alias("extras"),
    )


def read_document(df: DataFrame) -> DataFrame:
    """Rows ``ordinal, column_id, record, prefixes`` from nested catalogue documents.

    Columns keep the order of the document, which decides on suffixes of colliding names.
    """
    opened = df.select("prefixes", F.posexplode("columns").alias("ordinal", "column_id", "_fields"))
    record = normalise_record(F.col("_fields")).alias("record")
    return opened.select(F.col("ordinal").cast("long").alias("ordinal"), "column_id", record, "prefixes")
