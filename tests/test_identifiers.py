"""Identifiers against giving them out one by one."""

import random
import re

from cellweave.operators.identifiers import unique_identifiers


def one_by_one(names):
    used, out = set(), []
    for name in names:
        base = "column_" + re.sub(r"[^a-zA-Z0-9_-]", "_", name)
        identifier, n = base, 1
        while identifier in used:
            identifier = f"{base}_{n}"
            n += 1
        used.add(identifier)
        out.append(identifier)
    return out


def given(spark, names, partitions=4):
    df = spark.createDataFrame(list(enumerate(names)), "ordinal long, name string").repartition(partitions)
    rows = unique_identifiers(df, "name", "ordinal").collect()
    return [r.identifier for r in sorted(rows, key=lambda r: r.ordinal)]


def test_special_characters(spark):
    names = ["Column Name!", "Column@Name", "Column#Name", "Column Name", "Column-Name"]
    assert given(spark, names) == one_by_one(names)


def test_names_that_spell_out_a_suffix(spark):
    for names in (
        ["a", "a", "a_1"], ["a_1", "a", "a", "a"], ["a", "a_1", "a", "a_2", "a", "a_1"], ["a_2", "a_3", "a", "a", "a"],
        ["a", "a", "a_1", "a_1", "a_1_1", "a"], ["a", "a", "a_1_1", "a_1", "a_1", "a_01", "a_0", "a"],
        ["b_1", "b_2", "b_3", "b_5", "b", "b", "b", "b"],
    ):
        assert given(spark, names) == one_by_one(names), names


def test_random_families(spark):
    random.seed(3)
    for _ in range(4):
        names = []
        for _ in range(120):
            name = random.choice("ab")
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                name += f"_{random.randint(1, 6)}"
            names.append(name)
        assert given(spark, names) == one_by_one(names)


def test_one_name_for_a_third_of_all(spark):
    names = ["hot" if i % 3 == 0 else f"n{i % 50}" for i in range(6000)]
    assert given(spark, names, 8) == one_by_one(names)
