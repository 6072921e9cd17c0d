"""The default catalogue: annotations of thirteen columns of tables of insured banks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import vocab as V
from ..model import BNODE, IRI, LITERAL, TRIPLES

# Namespaces, and per column its label, description, datatype, references, entity, comment and
# further properties.
BASE = "http://example.org/fdic/"
FIBO = "https://spec.edmcouncil.org/fibo/ontology/"
GEO = "http://www.opengis.net/ont/geosparql#"
GEONAMES = "http://www.geonames.org/ontology#"
WGS84 = "http://www.w3.org/2003/01/geo/wgs84_pos#"
SCHEMA = "https://schema.org/"
VCARD = "http://www.w3.org/2006/vcard/ns#"
FOAF = "http://xmlns.com/foaf/0.1/"
DBPEDIA = "http://dbpedia.org/resource/"

COLUMNS = {
    "X": {
        "label": "X Coordinate",
        "description": "Longitude coordinate in decimal degrees",
        "type": "decimal",
        "see": [GEO + "hasGeometry", WGS84 + "long", SCHEMA + "longitude", "https://en.wikipedia.org/wiki/Longitude"],
        "same": "Q34027",
        "comment": "Maps to longitude in geographic coordinate system. X coordinate represents the east-west position",
        "more": [("references", "https://www.w3.org/2003/01/geo/wgs84_pos#")],
    },
    "Y": {
        "label": "Y Coordinate",
        "description": "Latitude coordinate in decimal degrees",
        "type": "decimal",
        "see": [GEO + "hasGeometry", WGS84 + "lat", SCHEMA + "latitude", "https://en.wikipedia.org/wiki/Latitude"],
        "same": "Q34028",
        "comment": "Maps to latitude in geographic coordinate system. Y coordinate represents the north-south position",
        "more": [("references", "https://www.w3.org/2003/01/geo/wgs84_pos#")],
    },
    "LONGITUDE": {
        "label": "Longitude",
        "description": "Geographic longitude",
        "type": "decimal",
        "see": [GEO + "longitude"],
        "equivalent": GEO + "longitude",
    },
    "LATITUDE": {
        "label": "Latitude",
        "description": "Geographic latitude",
        "type": "decimal",
        "see": [GEO + "latitude"],
        "equivalent": GEO + "latitude",
    },
    "NAME": {
        "label": "Institution Name",
        "description": "Legal name of financial institution",
        "type": "string",
        "see": [
            FIBO + "BE/LegalEntities/LegalPersons/hasLegalName", FIBO + "FBC/FinancialInstitution",
            SCHEMA + "BankOrCreditUnion", FOAF + "name",
            "https://www.investopedia.com/terms/f/financialinstitution.asp", "https://en.wikipedia.org/wiki/Bank",
        ],
        "same": "Q22687",
        "comment": "The official legal name of the FDIC-insured institution as registered with regulatory authorities",
        "more": [("references", DBPEDIA + "Bank")],
    },
    "ADDRESS": {
        "label": "Street Address",
        "description": "Physical street address of the institution",
        "type": "string",
        "see": [
            FIBO + "FND/Places/Addresses/StreetAddress", VCARD + "street-address", SCHEMA + "streetAddress",
            "https://pe.usps.com/text/pub28/welcome.htm",
        ],
        "comment": "Street address of the institution's physical location, formatted according to USPS standards",
        "more": [("conformsTo", "https://www.usps.com/manage/forward-mail.htm")],
    },
    "CITY": {
        "label": "City",
        "description": "City name",
        "type": "string",
        "see": [GEONAMES + "name"],
        "comment": "City where the institution is located",
    },
    "STALP": {
        "label": "State Code",
        "description": "State abbreviation",
        "type": "string",
        "see": [GEONAMES + "stateCode"],
        "comment": "Two-letter state abbreviation code",
    },
    "STNAME": {
        "label": "State Name",
        "description": "State name",
        "type": "string",
        "see": [GEONAMES + "name"],
        "comment": "Full name of the state",
    },
    "ZIP": {
        "label": "ZIP Code",
        "description": "United States Postal Service ZIP code",
        "type": "string",
        "see": [
            FIBO + "FND/Places/Addresses/PostCodeIdentifier", VCARD + "postal-code", SCHEMA + "postalCode",
            "https://tools.usps.com/go/ZipLookupAction", "https://en.wikipedia.org/wiki/ZIP_Code",
        ],
        "same": "Q136208",
        "comment": "5-digit Zone Improvement Plan (ZIP) postal code used by USPS for mail delivery",
        "more": [("conformsTo", "https://pe.usps.com/cpim/ftp/pubs/Pub28/pub28.pdf")],
    },
    "CERT": {
        "label": "FDIC Certificate Number",
        "description": "Unique FDIC-assigned certificate of insurance number",
        "type": "integer",
        "see": [
            FIBO + "BE/GovernmentIssuedLicense", FIBO + "FBC/RegulatoryLicense", SCHEMA + "identifier",
            "https://www.fdic.gov/resources/bankers/call-reports/crinst-031/2019/2019-03-crinst-031-rc-a.pdf",
            "https://en.wikipedia.org/wiki/Federal_Deposit_Insurance_Corporation#Certificate_numbers",
        ],
        "same": "Q116907062",
        "comment": (
            "Unique identifier assigned by the FDIC when granting deposit insurance. "
            "This number remains constant throughout the institution's existence"
        ),
        "issued": "Federal Deposit Insurance Corporation",
        "restriction": "FDIC Certificate Number",
    },
    "BKCLASS": {
        "label": "Bank Classification",
        "description": "Bank classification code",
        "type": "string",
        "see": [FIBO + "BE/Corporations/Corporations/OrganizationClassification"],
        "comment": "Classification code indicating the type of banking institution",
    },
    "SERVTYPE_DESC": {
        "label": "Service Type Description",
        "description": "Type of banking service provided",
        "type": "string",
        "see": [FIBO + "FND/ProductsAndServices/ProductsAndServices/Service"],
        "comment": "Description of the primary service type offered by the institution",
    },
}


def bank_catalogue(spark: SparkSession) -> DataFrame:
    """The default catalogue as triples."""
    rows = []
    for name, column in COLUMNS.items():
        subject = f"{BASE}column_{name}"

        def add(p, o, kind=LITERAL, lang=None, s=subject, datatype=None):
            rows.append((s, p, o, kind, datatype, lang))

        add(V.RDF_TYPE, V.CATALOGUE_BASE + "ColumnAnnotation", IRI)
        add(V.CATALOGUE_BASE + "columnName", name)
        add(V.LABEL, column["label"], lang="en")
        add(V.DESCRIPTION, column["description"])
        add(V.CATALOGUE_BASE + "dataType", V.XSD + column["type"], IRI)
        for iri in column["see"]:
            add(V.SEE_ALSO, iri, IRI)
        if "equivalent" in column:
            add(V.OWL + "equivalentProperty", column["equivalent"], IRI)
        if "same" in column:
            add(V.SAME_AS, V.WIKIDATA_ENTITY + column["same"], IRI)
        if "comment" in column:
            add(V.COMMENT, column["comment"], lang="en")
        for predicate, iri in column.get("more", []):
            add(V.DCTERMS + predicate, iri, IRI)
        if "issued" in column:
            add(V.DCTERMS + "issued", column["issued"])
        if "restriction" in column:
            node = "_:certificate"
            add(V.OWL + "equivalentClass", node, BNODE)
            add(V.RDF_TYPE, V.OWL + "Restriction", IRI, s=node)
            add(V.OWL + "onProperty", V.DCTERMS + "identifier", IRI, s=node)
            add(V.OWL + "value", column["restriction"], s=node, datatype=V.XSD + "string")
    return spark.createDataFrame(rows, TRIPLES)


def catalogue_or_default(spark: SparkSession, annotations: DataFrame | None, use_default: bool = True) -> DataFrame | None:
    """The given catalogue, else the default one, else none; lacking one is no error."""
    if annotations is not None:
        return annotations
    return bank_catalogue(spark) if use_default else None
