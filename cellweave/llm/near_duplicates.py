"""Near duplicates by MinHash with tensored banding.

Two small collections of minhashes are cut into bands, A and B. The key of table (i, j) joins band i of A with band j of
B, so that m + m bands serve m * m tables: computing minhashes costs about the square root of what separate tables would.
Two documents of similarity s share a table with probability ``(1 - (1 - s**rows)**m) ** 2``, which at 0.8 with the defaults
is above 0.999. Pairs that share a table are confirmed on the full sets of their texts.

Copies (equal sets) are one class. Within a table, members are compared with one hub only, so that no group is written out
as all its pairs; classes that this connects need no further comparison. Classes whose tables still hold several components
are then matched by their rarest shingles, of which similar sets share one: a class is compared with the members of another
component only if it shares such a shingle with it, and if their sketches do not rule out that they are similar. Both the tables
and the sketches may miss a pair; what was measured is in the README.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm import tables, words
from cellweave.llm.words import U

BANDS = 12
ROWS = 3
PERCENT = 80
# Pairs whose sketches agree in fewer places than this share of the minhashes are not confirmed: at a similarity of 0.8 one
# pair in some 50,000 lies below it.
SKETCH_SHARE = 0.59


def _functions(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20250101)
    n = 2 * bands * rows
    return r.integers(1, 1 << 63, n, dtype=U) * U(2) + U(1), r.integers(0, 1 << 63, n, dtype=U)


def fingerprints(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, class, bands_a, bands_b, sketch`` of each document; class stands for the set of shingles.

    The sketch has eight bits of each minhash.

    Null and empty texts, and texts without words, have no shingles and a null class.
    """
    a, b = _functions(bands, rows)

    def run(batch: pa.RecordBatch) -> pa.Table:
        n, cls, left, right, sketch = [], [], [], [], []
        for text in tables.utf8(batch["text"]):
            s = words.shingles(words.word_hashes(text, fold=True)[0], size)
            n.append(len(s))
            if not len(s):
                cls.append(None), left.append(None), right.append(None), sketch.append(None)
                continue
            with np.errstate(over="ignore"):
                key = np.array([s.sum(), words.mix(s + U(1)).sum()], U)
                cls.append(key.tobytes() + len(s).to_bytes(4, "little"))
                least = np.full(len(a), ~U(0))
                for at in range(0, len(s), 4096):
                    block = np.multiply.outer(a, s[at : at + 4096])
                    block += b[:, None]
                    np.minimum(least, block.min(axis=1), out=least)
                band = np.zeros(2 * bands, U)
                for row in least.reshape(2 * bands, rows).T:
                    band = words.mix(band * U(31) + row)
            signed = band.view(np.int64).tolist()
            left.append(signed[:bands]), right.append(signed[bands:])
            sketch.append((least >> U(24)).astype(np.uint8).view(np.int8))
        return pa.table({
            "doc_id": batch["doc_id"], "n_shingles": pa.array(n, pa.int64()), "class": pa.array(cls, pa.binary()),
            "bands_a": pa.array(left, pa.list_(pa.int64())), "bands_b": pa.array(right, pa.list_(pa.int64())),
            "sketch": pa.array(sketch, pa.list_(pa.int8())),
        })

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, class binary, bands_a array<long>, bands_b array<long>, sketch array<tinyint>"
    return tables.map_batches(picked, run, schema)


def shared_tables(classes: DataFrame) -> DataFrame:
    """Rows ``key, node, n, rep`` of all tables in which at least two classes meet, with the table's ``members`` > 1."""
    keyed = (
        classes.select("node", "n", "rep", "bands_b", F.posexplode("bands_a").alias("i", "a"))
        .select("node", "n", "rep", "i", "a", F.posexplode("bands_b").alias("j", "b"))
        .select(F.xxhash64("a", "b", "i", "j").alias("key"), "node", "n", "rep")
    )
    ordered = Window.partitionBy("key").orderBy("node")
    near = keyed.withColumns({"_before": F.lag("node").over(ordered), "_after": F.lead("node").over(ordered)})
    return near.where(F.col("_before").isNotNull() | F.col("_after").isNotNull()).drop("_before", "_after")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    """Sets of such sizes can reach the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of classes whose texts' full sets are similar enough: 100 * common >= percent * all."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")

    def run(batch: pa.RecordBatch) -> pa.Table:
        known: dict[bytes, set] = {}

        def of(text: bytes) -> set:
            if text not in known:
                w = text.lower().split()
                known[text] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}
            return known[text]

        keep = []
        for x, y in zip(tables.utf8(batch["text_a"]), tables.utf8(batch["text_b"]), strict=True):
            s, t = of(x), of(y)
            common = len(s & t)
            keep.append(100 * common >= percent * (len(s) + len(t) - common))
        return pa.table({"a": batch["a"], "b": batch["b"]}).filter(pa.array(keep, pa.bool_()))

    return tables.map_batches(both.select("a", "b", "text_a", "text_b"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node in ``links`` (a, b); connected nodes have one label, the smallest node.

    Labels spread to neighbours and then jump along themselves, so rounds grow with the logarithm of a chain's length.
    """
    links = tables.settle(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    labels = tables.settle(labels, "labels")
    while True:
        seen = links.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("_seen"))
        spread = labels.join(seen, "node").select("node", F.col("label").alias("_old"), F.least("label", "_seen").alias("_next"))
        jump = spread.select(F.col("node").alias("_next"), F.col("_next").alias("_jump"))
        after = spread.join(jump, "_next").select("node", "_old", F.least("_next", "_jump").alias("label"))
        after = tables.settle(after, "labels")
        if not after.where("label <> _old").limit(1).count():
            return after.select("node", "label")
        labels = after.select("node", "label")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text; other columns are not read).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Documents are linked when 100 * common >= percent * all shingles;
    component_id is the smallest doc_id reachable over links, itself included. Documents without words (null, empty, white
    space) are linked with nothing. Repeated rows are copies of each other and come back as often as they came. Rows with a null
    doc_id take part; they are kept only if nothing in their component has an id.
    """
    marks = tables.settle(fingerprints(docs, size, bands, rows), "marks")
    classes = tables.settle(
        marks.where("class IS NOT NULL").groupBy("class").agg(
            F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"),
            F.any_value("bands_a").alias("bands_a"), F.any_value("bands_b").alias("bands_b"),
            F.any_value("sketch").alias("sketch"),
        ).withColumn("node", F.xxhash64("class")),
        "classes",
    )
    shared = tables.settle(shared_tables(classes), "shared")
    texts = tables.settle(_texts(docs, classes.join(shared.select("node").distinct(), "node", "left_semi"), size), "texts")

    pairs = tables.settle(_hub_pairs(shared, percent), "pairs")
    links = tables.settle(confirm(pairs, texts, size, percent), "confirmed")
    named = tables.settle(
        classes.join(texts.select("node"), "node", "left_semi").join(components(links), "node", "left")
        .withColumn("label", F.coalesce("label", "node")).select("node", "n", "label", "sketch"),
        "named",
    )
    rare = tables.settle(_rarest(texts, _open_nodes(shared, named), size, percent), "rare")
    more = _between(rare, _meetings(rare, named, percent), named, percent).join(pairs, ["a", "b"], "left_anti")
    labels = components(links.unionByName(tables.settle(confirm(more, texts, size, percent), "confirmed")))

    named = classes.select("class", "node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("rep").alias("component"))
    of_class = named.select("class", "label").join(least, "label").select("class", "component")
    return marks.select("doc_id", "n_shingles", "class").join(of_class, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``node, text``: one text of each class given."""
    wanted = tables.settle(classes.select("rep", "node", "class"), "wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    found = rows.join(tables.small_side(wanted, 60), rows["rep"].eqNullSafe(wanted["rep"])).select("node", "class", "text")

    def run(batch: pa.RecordBatch) -> pa.Table:
        keep = []
        for cls, text in zip(batch["class"].to_pylist(), tables.utf8(batch["text"]), strict=True):
            s = words.shingles(words.word_hashes(text, fold=True)[0], size)
            with np.errstate(over="ignore"):
                key = np.array([s.sum(), words.mix(s + U(1)).sum()], U).tobytes() if len(s) else b""
            keep.append(cls[:16] == key)
        return pa.table({"node": batch["node"], "text": batch["text"]}).filter(pa.array(keep, pa.bool_()))

    # repeated rows of one doc_id may hold several texts of a class, or texts of another one
    return tables.map_batches(found, run, "node long, text string").groupBy("node").agg(F.any_value("text").alias("text"))


def _hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each member of a table with the table's hub, the class of the smallest document."""
    at = Window.partitionBy("key").orderBy(F.col("rep").asc_nulls_last(), F.col("node"))
    hub = rows.withColumn("h", F.first(F.struct("node", "n")).over(at))
    return (
        hub.where((F.col("h.node") != F.col("node")) & _sizes_fit(F.col("h.n"), F.col("n"), percent))
        .select(F.least("h.node", "node").alias("a"), F.greatest("h.node", "node").alias("b"))
        .distinct()
    )


def _open_nodes(shared: DataFrame, named: DataFrame) -> DataFrame:
    """Classes in tables whose members are not all in one component, and not just a pair that has been compared."""
    per = shared.join(named.select("node", "label"), "node").groupBy("key").agg(
        F.count(F.lit(1)).alias("k"), F.min("label").alias("first"), F.max("label").alias("last")
    )
    return shared.join(per.where("k > 2 AND first <> last").select("key"), "key", "left_semi").select("node").distinct()


def _rarest(texts: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """``key, node, n, at`` of the rarest shingles of each class, as many as a similar set must share one of.

    Sets of which a share of ``percent`` is common have one of the n - ceil(percent * n / 100) + 1 rarest elements in common.
    """

    def run(batch: pa.RecordBatch) -> pa.Table:
        sets = [words.shingles(words.word_hashes(x, fold=True)[0], size).view(np.int64) for x in tables.utf8(batch["text"])]
        at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return pa.table({
            "node": batch["node"].take(pa.array(at)), "n": pa.array(np.array([len(s) for s in sets], np.int64)[at]),
            "key": pa.array(np.concatenate(sets) if sets else np.array([], np.int64)),
        })

    rows = tables.settle(tables.map_batches(texts.join(nodes, "node", "left_semi").select("node", "text"), run, "node long, n long, key long"), "sets")
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("node").orderBy("often", "key")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # shingles of one class meet nothing, but count for the order
    return (
        rows.join(often, "key").withColumn("at", F.row_number().over(order)).where((F.col("at") <= first) & (F.col("often") > 1))
        .select("key", "node", "n", "at")
    )


def _meetings(rows: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """``node, other, others``: a class and another component with which it shares a key, seen from the smaller component.

    ``others`` is the size of that component. A key gives a row per class and component in it, not per pair of classes. Sets of
    n and m elements that are similar have at least c * (n + m) in common; all of them come at or after the first common one,
    so a key counts only if enough elements follow on both sides.
    """
    c = percent / (100 + percent)
    sizes = named.groupBy("label").agg(F.count(F.lit(1)).alias("others"))
    reach = (1 - c) * F.col("n") - F.col("at") + 1.000001
    own = rows.join(named.select("node", "label"), "node").select("key", "node", "label", "n", reach.alias("reach"))
    in_key = own.groupBy("key", "label").agg(F.max("reach").alias("their_reach"), F.min("n").alias("their_least"))
    mixed = in_key.groupBy("key").agg(F.count(F.lit(1)).alias("_labels")).where("_labels > 1").select("key")
    there = in_key.join(mixed, "key").withColumnRenamed("label", "other").join(sizes.withColumnRenamed("label", "other"), "other")
    own = own.join(mixed, "key").join(sizes.withColumnRenamed("others", "size"), "label")
    smaller = (F.col("size") < F.col("others")) | ((F.col("size") == F.col("others")) & (F.col("label") < F.col("other")))
    enough = (F.col("reach") >= c * F.col("their_least")) & (F.col("their_reach") >= c * F.col("n"))
    return own.join(there, "key").where(smaller & enough & (F.col("label") != F.col("other"))).select("node", "other", "others").distinct()


def _between(rare: DataFrame, meetings: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs of a class and those members of a component it has met that share a key early enough with it.

    Of these, sketches rule out most that are not similar.
    """
    c = percent / (100 + percent)
    rows = rare.select("key", "node", "n", "at").join(named.select("node", "label", "sketch"), "node")
    x = rows.drop("label").join(meetings.select("node", "other"), "node").select(
        "key", "other", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("at").alias("at_x"), F.col("sketch").alias("sketch_x")
    )
    y = rows.select(
        "key", F.col("label").alias("other"), F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("at").alias("at_y"),
        F.col("sketch").alias("sketch_y"),
    )
    follow = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) + 1.000001
    agree = F.size(F.filter(F.zip_with("sketch_x", "sketch_y", lambda u, v: u == v), lambda same: same))
    return (
        x.join(y, ["key", "other"])
        .where(_sizes_fit(F.col("n_x"), F.col("n_y"), percent) & (follow >= c * (F.col("n_x") + F.col("n_y"))) & (agree >= SKETCH_SHARE * F.size("sketch_x")))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def keep_first(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, with all their columns, of one document per component: that of the smallest doc_id.

    Documents without words are in no group and stay. Repeated rows (equal doc_id and text) stay once. Rows without doc_id come
    after all others, and those of equal texts are one document.
    """
    nameless = F.lit(1 << 62) + F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(1 << 61))
    # the row's own columns stay in one struct, whatever they are called
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), nameless).alias("key"), F.col("text").cast("string").alias("text"))
    found = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"), size, percent)
    found = tables.settle(found.select(F.col("doc_id").alias("key"), "kept"), "found")
    gone = tables.settle(found.where("NOT kept").select("key").distinct(), "gone")
    often = tables.settle(found.where("kept").groupBy("key").count().where("count > 1").select("key"), "often")
    rows = keyed.join(tables.small_side(gone, 16), "key", "left_anti")
    once = rows.join(tables.small_side(often, 16), "key", "left_anti")
    repeated = rows.join(tables.small_side(often, 16), "key", "left_semi").dropDuplicates(["key", "text"])
    return once.unionByName(repeated).select("row.*")
