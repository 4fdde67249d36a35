import random
import re

from pyspark.sql import functions as F

from tarifa.llm.common import components
from tarifa.llm.near_dup import near_duplicates
from tests.llm.tables import docs_of, needs_tables, roots, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    width = min(size, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    root = roots(list(sets), links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def found(spark, rows, size):
    result = near_duplicates(docs_of(spark, rows), shingle=size).collect()
    assert len(result) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in result}


@needs_tables
def test_whole_table_equals_brute_force(spark):
    rows = texts(spark)
    assert found(spark, rows, 4) == brute(rows, 4)


def test_large_group_of_near_copies_and_edge_cases(spark):
    chance = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):  # variants with few to many changes: some link, some do not
        words = list(base)
        for _ in range(chance.randrange(0, 9)):
            words[chance.randrange(len(words))] = f"x{chance.random()}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "one"), (7, "é è ê ë ç à"), (8, "é è ê ë ç à")]
    rows += [(20, "long " * 30000 + "end"), (21, "long " * 30001 + "end")]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f")]
    result = near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in result) == [(-1, -1, True), (3, 3, True), (3, 3, True), (9, 3, False)]
    assert near_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    chance = random.Random(5)
    names = chance.sample(range(10_000), 300)
    links = [*zip(names[:200], names[1:200]), *zip(names[200:], names[201:])]
    chance.shuffle(links)
    result = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in result} == roots(names, links)


def test_pairs_within_a_large_group_of_one_template(spark):
    # all share a template at similarity 0.69, so regions are large; each is linked with one other row, far away by id
    half, words = 500, [f"t{i}" for i in range(200)]
    rows = []
    for i in range(half):
        own = words + [f"p{i}-{k}" for k in range(20)]
        rows += [(i + side * half, " ".join(own + [f"r{i}-{side}-{k}" for k in range(25)])) for side in range(2)]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_one_id_on_several_texts_and_many_repeated_rows(spark):
    long = [" ".join(f"{k}{i}" for i in range(60)) for k in "ab"]
    near = [t + " more" for t in long]
    rows = [(1, long[0]), (1, long[1]), (2, near[0]), (3, near[1]), (7, long[0] + " x"), (7, "another text of its own here")] + [(5, near[0])] * 1000
    result = near_duplicates(docs_of(spark, rows).withColumn("mark", F.substring("text", 1, 2)), carry=("mark",)).collect()
    assert len(result) == len(rows)
    got = {(r["doc_id"], r["mark"], r["component_id"], r["kept"]) for r in result}
    assert got == {(1, "a0", 1, True), (1, "b0", 1, True), (2, "a0", 1, False), (3, "b0", 1, False), (5, "a0", 1, False), (7, "a0", 1, False), (7, "an", 7, True)}
