"""Fixed values of the graph vocabulary: namespaces, code tables, conversion profiles.

Everything in this module is a constant that must have exactly this text for results to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

# Well-known namespaces.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCTERMS = "http://purl.org/dc/terms/"
DCAT = "http://www.w3.org/ns/dcat#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
CSVW = "http://www.w3.org/ns/csvw#"
WIKIDATA_ENTITY = "http://www.wikidata.org/entity/"

# Fixed value: the namespace in which catalogue classes and properties live.
CATALOGUE_BASE = "http://example.org/csv2rdf/"

RDF_TYPE = RDF + "type"
LABEL = RDFS + "label"
COMMENT = RDFS + "comment"
SEE_ALSO = RDFS + "seeAlso"
SAME_AS = OWL + "sameAs"
DESCRIPTION = DCTERMS + "description"

# Relation code -> predicate. An absent code means "related"; an unknown one is dropped.
RELATION_PREDICATES = {
    "equivalent": OWL + "equivalentProperty",
    "exact": OWL + "equivalentProperty",
    "similar": RDFS + "seeAlso",
    "instance_of": RDF + "type",
    "subclass_of": RDFS + "subClassOf",
    "related": RDFS + "seeAlso",
    "broader": SKOS + "broader",
    "narrower": SKOS + "narrower",
}
DEFAULT_RELATION = "related"

# Datatype codes; each stands for the XSD type of the same name.
DATATYPE_CODES = (
    "string", "integer", "decimal", "float", "double",
    "boolean", "date", "dateTime", "time", "anyURI",
)
DEFAULT_DATATYPE = "string"

# Dataset metadata key -> (predicate, kind of object). Other keys use the catalogue namespace.
DATASET_KEYS = {
    "title": (DCTERMS + "title", "literal"),
    "description": (DCTERMS + "description", "literal"),
    "publisher": (DCTERMS + "publisher", "literal"),
    "source": (DCTERMS + "source", "iri"),
    "license": (DCTERMS + "license", "iri"),
}

# Record fields that are not "extra" properties.
RECORD_FIELDS = (
    "label", "description", "semantic_type", "data_type", "mappings", "references", "comments",
)

# Fixed value: the comment of the catalogue class itself, never a column comment.
CLASS_COMMENT = "Represents semantic annotations for CSV columns"

# Rows per page or chunk, worker estimate, preview size.
ROWS_PER_PART = 1000
ESTIMATED_TRIPLES_PER_ROW = 50
PREVIEW_ROWS = 20
PREVIEW_WIDTH = 50


@dataclass(frozen=True)
class Profile:
    """How a table is written as a graph.

    ``encode`` percent-encodes IRI parts. ``typed`` infers number types per cell, otherwise values are
    plain strings. ``indexed_rows`` emits the row's index and a table->row link; ``row_to_cell`` emits
    the inverse row->cell link.
    """

    name: str
    base: str
    ontology: str
    title_prefix: str
    cell_row: str
    cell_column: str
    encode: bool
    typed: bool
    indexed_rows: bool
    row_to_cell: bool

    def term(self, local: str) -> str:
        return self.ontology + local

    @property
    def triples_per_row(self) -> int:
        return 3 if self.indexed_rows else 1

    @property
    def triples_per_cell(self) -> int:
        return 5 if self.row_to_cell else 4

    def metadata_count(self, columns: int) -> int:
        """Triples of a table with this many columns, before rows, cells and annotations."""
        return 3 + 4 * columns

    def data_count(self, rows, cells):
        """Triples of that many rows and non-blank cells; numbers or columns."""
        return rows * self.triples_per_row + cells * self.triples_per_cell


# The two conversion profiles with their default namespaces.
PLAIN = Profile(
    name="plain",
    base="https://fdic.example.org/data/",
    ontology="https://fdic.example.org/ontology#",
    title_prefix="FDIC Table: ",
    cell_row="inRow",
    cell_column="inColumn",
    encode=True,
    typed=False,
    indexed_rows=True,
    row_to_cell=False,
)
TYPED = Profile(
    name="typed",
    base="https://example.org/data/",
    ontology="https://example.org/ontology#",
    title_prefix="Table: ",
    cell_row="row",
    cell_column="column",
    encode=False,
    typed=True,
    indexed_rows=False,
    row_to_cell=True,
)
