import pytest

from strandlake.contracts import MethylationSet
from strandlake.functions import names
from strandlake.plans.sql import close_store, open_store
from strandlake.sinks.store import write_store


@pytest.fixture
def store(spark, tmp_path):
    sites = spark.createDataFrame([(0, "chr1", "1", 9, 11, "+"), (1, "chr1", "1", 99, 101, "+"), (2, "chrM", "MT", 9, 11, "+")], "cpg_idx long, chr string, contig_key string, start long, end long, strand string")
    samples = spark.createDataFrame([(0, "a", "a"), (1, "b", "b")], "sample_idx int, sample_id string, sample_name string")
    cells = spark.createDataFrame([(0, 0, 5, 0.5), (1, 0, 7, 1.0), (1, 1, 3, 0.0), (2, 1, 9, 0.25)], "cpg_idx long, sample_idx int, cov long, beta float")
    write_store(MethylationSet(sites, samples, cells, "g", 3), f"{tmp_path}/store")
    return f"{tmp_path}/store"


def test_views_and_functions(spark, store):
    made = open_store(spark, store, "mine")
    rows = lambda text: sorted(tuple(r) for r in spark.sql(text).collect())
    assert rows("SELECT sample_id, cpg_idx, cov, beta FROM mine_cells_in('CHR1', 50, 100)") == [("a", 1, 7, 1.0), ("b", 1, 3, 0.0)]
    assert rows("SELECT contig_key, position FROM mine_cells_in('chrM', 1, 10)") == [("MT", 10)]
    assert rows("SELECT * FROM mine_cells_in('2', 1, 1000)") == []
    assert rows("SELECT sample_id, count(*) FROM mine_samples LEFT JOIN mine_cells USING (sample_id) GROUP BY ALL") == [("a", 2), ("b", 2)]
    lateral = "SELECT r.c, x.sample_id FROM (VALUES ('1', 10), ('M', 10)) r(c, p), LATERAL mine_cells_in(r.c, r.p, r.p) x"
    assert rows(lateral) == [("1", "a"), ("M", "b")]
    for name in ("chr1", " CHRx ", "M", "chrM", "MT", "Chr1", "chrchr2"):
        assert spark.sql("SELECT mine_contig_key(:n)", args={"n": name}).first()[0] == names.canonical_contig(name)
    other = open_store(spark, store, "other")  # side by side
    close_store(spark, made)
    assert rows("SELECT count(*) FROM other_cells") == [(4,)]
    close_store(spark, other)
    assert not {*made, *other} & {t.name for t in spark.catalog.listTables()}


def test_the_prefix_is_a_plain_name(spark, store):
    with pytest.raises(ValueError, match="plain lower-case name"):
        open_store(spark, store, "x; drop")
