"""Each operator and pipeline stage on odd rows and on tables whose columns have names of its own."""

import pytest

import corpus_pipeline
from tessera.llm import byte_cnn, gif_media, line_dedup, packing, piece_codec, quality_rules, substring_dedup, token_store, toxicity
from tessera.llm.jaccard_join import jaccard_groups

NAMES = "n_lines n_removed_lines removed score predicted held_out start n_tokens ids_crc32 component_id n_links n_shingles rep tokens part window fault gif n_bytes kept lines at c words t s e k body places units marks source large size blocks y __tessera_x".split()
TEXT = "First line of it here.\nSecond line of it there.\nA third line, and some words more."
ROWS = [(1, TEXT), (2, TEXT), (2, TEXT), (3, None), (4, ""), (5, " \n "), (6, "x"), (7, "word " * 50000), (8, "own " + TEXT + "\n" + TEXT), (None, TEXT), (9, "\r\n\0\u2028\ud7ff"), (-5, "negative id")]
LABELS = "/root/testdata/sf0.001/labels.parquet"
OPERATORS = {
    "line_dedup": lambda d, y: line_dedup.line_dedup(d),
    "toxicity": toxicity.toxicity_scores,
    "tokens": lambda d, y: token_store.read_tokens(token_store.write_tokens(d)),
    "gif": lambda d, y: gif_media.stored_and_read(d),
    "pieces": lambda d, y: piece_codec.piece_digests(d),
    "packing": lambda d, y: packing.pack(d),
    "quality": byte_cnn.quality_scores,
    "rules": lambda d, y: quality_rules.quality_rules(d),
    "substring": lambda d, y: substring_dedup.substring_dedup(d),
    "jaccard": lambda d, y: jaccard_groups(d),
}
KEEPS_NO_ID = {"line_dedup", "rules", "substring"}


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


@pytest.fixture(scope="module")
def clashing(spark):
    return spark.createDataFrame([(*r, *([7] * len(NAMES))) for r in ROWS], "doc_id long, text string, " + ", ".join(f"`{x}` int" for x in NAMES))


def rows_of(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, plain, clashing, name):
    """Clashing columns change nothing; rows, their doubles and an empty table come out as they should."""
    labels, run = spark.read.parquet(LABELS), OPERATORS[name]
    want = run(plain, labels)
    columns = want.columns
    got = run(clashing, labels)
    assert set(columns) <= set(got.columns) and rows_of(got, columns) == rows_of(want, columns)
    if name != "packing":
        assert want.count() == len(ROWS) - (name not in KEEPS_NO_ID)
    assert run(clashing.where("false"), labels).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, plain, clashing, name, stage):
    """Each stage by itself: null, empty and repeated rows, columns named like its own, an empty table."""
    folder = "/root/testdata/sf0.001"
    for df in (plain, clashing):
        out = stage(spark, df, folder)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {i for i, _ in ROWS if i is not None}
            continue
        assert out.columns == df.columns and out.schema == df.schema
        kept = [r.doc_id for r in out.collect()]
        if name in ("line_dedup", "substring_dedup"):
            assert len(kept) == len(ROWS)
        if name == "ngram_jaccard_join":
            assert 1 in kept and kept.count(2) == 0 and {3, 4, 5, 6, 7, 9, -5, None} <= set(kept)
    assert stage(spark, clashing.where("false"), folder).count() == 0


def test_shared_folder(spark, monkeypatch):
    """On a cluster the folder must be named."""
    from tessera.llm import common

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda name, other: other)})
        sparkContext = type("Context", (), {"master": "spark://there:7077"})

    with pytest.raises(ValueError):
        common.shared_dir(Cluster())
    assert common.shared_dir(spark)


LONG_A, LONG_B = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
LINES_X, LINES_Y = ("\n".join(f"A {c} line of its own, number {i}." for i in range(12)) for c in "xy")


def test_rows_of_one_id_lines(spark):
    """Rows that share a doc_id are told apart by their text: what repeats in one of them leaves the other alone."""
    df = spark.createDataFrame([(1, LINES_X), (2, LINES_X), (2, LINES_Y)], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed_lines, r.text) for r in line_dedup.line_dedup(df).collect()}
    assert (1, 0, LINES_X) in got and (2, 0, LINES_Y) in got and len(got) == 3 and max(n for _, n, _ in got) >= 10


def test_digests_that_meet(spark, monkeypatch):
    """Bodies of one digest are compared by their bytes, and still removed where they repeat."""
    df = spark.createDataFrame([(1, LINES_X), (2, LINES_X + "\n" + LINES_Y), (3, LINES_Y), (4, "One line.\nAnd one.")], "doc_id long, text string")
    want = sorted(map(tuple, line_dedup.line_dedup(df).collect()))
    monkeypatch.setattr(line_dedup, "DIGEST", "'same'")
    monkeypatch.setattr(line_dedup, "BODY_HASH", "0L")
    assert sorted(map(tuple, line_dedup.line_dedup(df).collect())) == want and sum(r[3] for r in want) >= 8


def test_rows_of_one_id_passages(spark):
    passage = "Here " + " ".join(f"passage{i}" for i in range(60)) + "."
    own = "Quite " + " ".join(f"other{i}" for i in range(40)) + "."
    df = spark.createDataFrame([(1, passage), (2, own + " " + passage), (2, own.replace("other", "else"))], "doc_id long, text string")
    got = {r.text: [tuple(x) for x in r.removed] for r in substring_dedup.substring_dedup(df).collect()}
    assert got == {passage: [], own + " ": [(len(own) + 1, len(own) + 1 + len(passage), 1)], own.replace("other", "else"): []}


def test_rows_of_one_id_near_copies(spark):
    """The smallest doc_id of a group may be another group's, too."""
    near = LONG_B + " tail"
    df = spark.createDataFrame([(5, LONG_A), (5, LONG_B), (7, near), (8, near), (9, LONG_A + " more"), (9, "x y z")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.n_links) for r in jaccard_groups(df).collect())
    assert got == [(5, 5, 1), (5, 5, 1), (7, 5, 1), (8, 5, 1), (9, 5, 1), (9, 9, 0)]
    kept = corpus_pipeline.jaccard_stage(spark, df, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, kept)) == sorted([(5, LONG_A), (5, LONG_B), (9, "x y z")])
