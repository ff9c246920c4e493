"""Operators on small hand-made tables."""

import json
import math
import random
import re

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curatrix.functions import text as T
from curatrix.operators import corr, expression, filters, metadata, quality, reads, rules, sampling, taxonomy, tmm
from curatrix.sources import tables as X

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = sorted(k for k in entry.queries() if not re.match(r"op\d|pipeline$", k))


@pytest.fixture(scope="session")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(rows, columns):
    def one(v):
        if v is None or isinstance(v, float) and v != v:
            return None
        return round(float(v), 5) if isinstance(v, float) else int(v) if hasattr(v, "item") else v if isinstance(v, (bool, str)) else float(v) if not isinstance(v, int) else v

    return sorted(json.dumps([one(r[c]) for c in columns], default=str) for r in rows)


QUICK = [n for i, n in enumerate(OWN) if n in entry.oracle_sql()]


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_sql(spark, sf_dir, sql, name):
    got = entry.queries()[name](spark, sf_dir)
    want = sql.execute(entry.oracle_sql()[name])
    columns = sorted(x[0] for x in want.description)
    assert sorted(got.columns) == columns
    rows = [dict(zip([x[0] for x in want.description], r)) for r in want.fetchall()]
    a, b = plain([r.asDict() for r in got.collect()], columns), plain(rows, columns)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(json.loads(x), json.loads(y)):
            assert u == v or (isinstance(u, (int, float)) and isinstance(v, (int, float)) and math.isclose(u, v, rel_tol=1e-5, abs_tol=2e-5)), (x, y)


def test_trim_ranks_of_the_factor(spark):
    """Random counts of three runs, ties among them, against the trimmed mean by hand."""
    rng = random.Random(11)
    table = {r: [rng.choice([0, 3, 7, 12, 30, 55, 80]) + (r == "b") * k for k in range(23)] for r in "abc"}
    counts = spark.createDataFrame([(f"g{k}", r, float(v)) for r, vs in table.items() for k, v in enumerate(vs)], "target_id string, run string, value double")
    got = {r.run: r.factor for r in tmm.tmm_factor(counts, tmm.library_sizes(counts), "a").collect()}

    def ranks(x):
        return [sum(v < u for v in x) + (sum(v == u for v in x) + 1) / 2 for u in x]

    assert got["a"] == 1.0
    for r in "bc":
        na, nr = sum(table["a"]), sum(table[r])
        both = [(x / nr, y / na, x, y) for x, y in zip(table[r], table["a"]) if x and y]
        m, a = [math.log2(p / q) for p, q, _, _ in both], [math.log2(p * q) / 2 for p, q, _, _ in both]
        n = len(both)
        cut_m, cut_a = int(0.3 * n) + 1, int(0.05 * n) + 1
        keep = [i for i, (x, y) in enumerate(zip(ranks(m), ranks(a))) if cut_m <= x <= n + 1 - cut_m and cut_a <= y <= n + 1 - cut_a]
        w = [1 / ((nr - both[i][2]) / nr / both[i][2] + (na - both[i][3]) / na / both[i][3]) for i in keep]
        assert keep and got[r] == pytest.approx(2 ** (sum(m[i] * v for i, v in zip(keep, w)) / sum(w)))


def test_toy_factors(spark):
    rows = [("g%02d" % i, f"s{j}", float(v)) for i in range(50) for j, v in enumerate((10, 10, 20, 20) if i < 25 else (10, 10, 0, 0))]
    counts = spark.createDataFrame(rows, "target_id string, run string, value double")
    f = [r.factor for r in tmm.tmm_normalize(counts).orderBy("run").collect()]
    assert f == pytest.approx([2**-0.5, 2**-0.5, 2**0.5, 2**0.5])
    assert math.prod(f) == pytest.approx(1)


def test_tau_values(spark):
    rows = [("a", g, v) for g, v in (("x", 6.0), ("y", 1.0), ("z", 1.0))] + [("b", g, 0.0) for g in "xyz"]
    means = spark.createDataFrame(rows, "target_id string, sample_group string, value double")
    got = {r.target_id: r.tau for r in expression.tau(means).collect()}
    assert got["a"] == pytest.approx(5 / 6) and got["b"] is None
    rank = {r.target_id: r.ranking for r in expression.tau_ranking(means).collect()}
    assert rank == {"a": "x|y|z", "b": ""}


def test_correlation_of_constant_and_missing_vectors(spark):
    rows = [(f"t{i}", "a", float(i)) for i in range(6)] + [(f"t{i}", "b", 5.0) for i in range(6)] + [(f"t{i}", "c", float(-i) if i else None) for i in range(6)] + [("t1", "d", 1.0)]
    expr = spark.createDataFrame(rows, "target_id string, run string, value double")
    got = {(r.run_a, r.run_b): (r.n_pairs, r.r) for r in corr.correlation_matrix(expr).collect()}
    assert got[("a", "c")][0] == 5 and got[("a", "c")][1] == pytest.approx(-1)
    assert got[("a", "b")][1] is None and got[("a", "d")] == (1, None)


def test_block_pairs_give_the_same_matrix(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(f"t{i}", f"r{j}", rng.random()) for i in range(30) for j in range(12) if rng.random() < 0.9]
    expr = spark.createDataFrame(rows, "target_id string, run string, value double")
    one = {(r.run_a, r.run_b): r.r for r in corr.correlation_matrix(expr).collect()}
    monkeypatch.setattr(corr, "RUN_BLOCK", 3)
    monkeypatch.setattr(corr, "TARGET_CHUNK", 8)
    many = {(r.run_a, r.run_b): r.r for r in corr.correlation_matrix(expr).collect()}
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k]) for k in one)


def test_small_groups_and_flat_groups_of_the_robust_z(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 30.0), ("b", 1.0), ("b", 2.0), ("c", 4.0), ("c", 4.0), ("c", 4.0)]
    got = filters.robust_z(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    z = sorted((r.g, r.v, r.z) for r in got)
    assert z[2][2] == pytest.approx(28 / 1.4826) and z[3][2] is None and z[5][2] == 0.0
    flags = filters.flag_margin_outliers(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", 1.5).collect()
    assert [r.v for r in flags if r.flag] == [1.0]  # the small group goes by the margin
    assert not [r for r in filters.flag_margin_outliers(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", 1.5, policy="retain").collect() if r.flag]


def test_ws_filter_drops_the_swapped_run(spark):
    import random

    rng = random.Random(1)
    base = {g: [rng.random() for _ in range(40)] for g in "xy"}
    rows, meta = [], []
    for k in range(10):
        g = "x" if k < 5 else "y"
        real = "y" if k == 0 else g
        meta.append((f"r{k}", "s", g, f"p{k}", "no"))
        rows += [(f"t{i}", f"r{k}", v + rng.random() * 0.1) for i, v in enumerate(base[real])]
    out = filters.wsfilter(spark.createDataFrame(rows, "target_id string, run string, value double"), spark.createDataFrame(meta, "run string, species string, sample_group string, bioproject string, exclusion string"), 0.0, 0.0)
    assert {r.run: r.exclusion for r in out.collect() if r.exclusion != "no"} == {"r0": "low_within_sample_group_correlation"}


def test_rule_folds_keep_protection_and_stop(spark):
    base = {f: "" for f in rules.FIELDS} | {"enabled": "yes", "stage": "exclude", "target_column": "exclusion", "columns": "t"}
    loaded = rules.load_rules([base | {"rule_id": "b", "priority": 2, "pattern": "x", "outcome": "second", "stop_on_match": "yes"}, base | {"rule_id": "a", "priority": 1, "pattern": "x|y", "outcome": "first", "stop_on_match": "no"}, base | {"rule_id": "c", "priority": 3, "pattern": "x", "outcome": "third", "stop_on_match": "no"}, base | {"rule_id": "d", "enabled": "no"}])
    df = spark.createDataFrame([("x", ""), ("y", "no"), ("x", "kept reason"), ("z", "")], "t string, exclusion string")
    assert [r.exclusion for r in rules.exclude_rules(df, loaded).collect()] == ["second", "first", "kept reason", ""]
    with pytest.raises(ValueError):
        rules.load_rules([base | {"rule_id": "a", "priority": 1, "stage": "nowhere"}])


def test_flags_and_numbers_raise_or_go_missing(spark):
    df = spark.createDataFrame([("Yes",), ("0",), (None,)], "v string")
    assert [r[0] for r in df.select(T.to_flag(F.col("v"), False)).collect()] == [True, False, False]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("maybe",)], "v string").select(T.to_flag(F.col("v"))).collect()
    df = spark.createDataFrame([("1e3",), ("inf",), ("NaN",), ("x",)], "v string")
    assert [r[0] for r in df.select(T.to_number(F.col("v"))).collect()] == [1000.0, None, None, None]


def test_update_join_rejects_unknown_and_repeated_runs(spark):
    src = spark.createDataFrame([("a", "1"), ("b", None)], "run string, v string")
    good = metadata.update_by_run(src, spark.createDataFrame([("b", "2", "n")], "run string, v string, w string"))
    assert sorted(map(tuple, good.collect())) == [("a", "1", None), ("b", "2", "n")]
    for bad in ([("c", "3")], [("a", "3"), ("a", "4")]):
        with pytest.raises(PySparkException):
            metadata.update_by_run(src, spark.createDataFrame(bad, "run string, v string")).collect()


def test_round_robin_takes_every_project_first(spark):
    rows = [("s", "g", f"p{i % 3}", f"r{i}", "no") for i in range(30)]
    out = sampling.sample_max_diversity(spark.createDataFrame(rows, "scientific_name string, sample_group string, bioproject string, run string, exclusion string"), 4, 1)
    assert sorted(r["count"] for r in out.where("is_sampled = 'yes'").groupBy("bioproject").count().collect()) == [1, 1, 2]


def test_merged_ids_are_followed(spark):
    m = spark.createDataFrame([(1, 2), (2, 3)], "old_taxid long, new_taxid long")
    got = {r.taxid: r.current for r in taxonomy.resolve_merged(spark.createDataFrame([(1,), (3,), (9,)], "taxid long"), m).collect()}
    assert got == {1: 3, 3: 3, 9: 9}
    with pytest.raises(RuntimeError):
        taxonomy.resolve_merged(spark.createDataFrame([(1,)], "taxid long"), spark.createDataFrame([(1, 2), (2, 1)], "old_taxid long, new_taxid long"), hops=3)


def test_read_headers(spark):
    df = spark.createDataFrame([("@a.1/2 x",), ("@a.1 1:N:0",), ("b",)], "h string")
    assert [tuple(r) for r in df.select(T.read_core(F.col("h")), T.read_mate(F.col("h"))).collect()] == [("a.1", 2), ("a.1", 1), ("b", None)]


def test_second_round_hands_the_shortfall_on(spark):
    rows = [(1, 100.0, 50, 50, 3000.0, 1.0), (2, 100.0, 40, 0, 1000.0, 1.0), (3, 100.0, 100, 0, 1000.0, 1.0)]
    got = reads.second_round_ranges(spark.createDataFrame(rows, "pos int, spot_length double, total_spots long, used_spots long, target_bp double, rate double"))
    assert [r.reads for r in got.orderBy("pos").collect()] == [0, 40, 10]


def test_contract_names_the_first_broken_rule(spark):
    rows = [("a", "t1", 1.0, 1.0, 1.0, 1.0), ("a", " ", 1.0, 1.0, 1.0, 1.0), ("b", "t1", 1.0, 1.0, float("inf"), 1.0), ("c", "t1", 1.0, 1.0, 1.0, 1.0), ("c", "t1 ", 1.0, 1.0, 1.0, 1.0), ("d", "t1", 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "run string, target_id string, length double, eff_length double, est_counts double, tpm double")
    assert {r.run: r.problem for r in quality.check_table_contract(df, ["run"]).collect()} == {"a": "blank target_id", "b": "invalid est_counts", "c": "repeated target_id", "d": ""}
    assert "tpm" in quality.check_table_contract(df.drop("tpm"), ["run"]).first().problem


# sources


def test_metadata_round_trip(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("run\tscientific_name\textra\nR1 \tNA\tx\nR2\tHomo sapiens\tnull\n\t\tz\n")
    m = X.read_metadata(spark, str(tmp_path / "m.tsv"))
    assert m.columns[: len(X.CORE_COLUMNS)] == list(X.CORE_COLUMNS) and m.columns[-1] == "extra"
    assert [(r.run, r.scientific_name, r.extra, r.exclusion) for r in m.orderBy("run").collect()] == [("", "", "z", "no"), ("R1", "NA", "x", "no"), ("R2", "Homo sapiens", "null", "no")]
    X.write_metadata(m.where("run <> ''"), str(tmp_path / "out"))
    assert X.read_metadata(spark, str(tmp_path / "out")).count() == 2
    (tmp_path / "d.tsv").write_text("run\nR1\nR1\n")
    with pytest.raises(PySparkException):
        X.read_metadata(spark, str(tmp_path / "d.tsv")).collect()


def test_quant_folders(spark, tmp_path):
    for run, n in (("R1", 5.0), ("R2", 7.0)):
        (tmp_path / run).mkdir()
        (tmp_path / run / "abundance.tsv").write_text(f"target_id\tlength\teff_length\test_counts\ttpm\n t1\t10\t9\t{n}\t1\n")
        (tmp_path / run / "run_info.json").write_text(json.dumps({"p_pseudoaligned": n * 10} if run == "R1" else {"length_model": "none", "quant_backend": "x"}))
    got = X.read_abundance(spark, [str(tmp_path / "*" / "abundance.tsv")])
    assert sorted((r.run, r.target_id, r.est_counts) for r in got.collect()) == [("R1", "t1", 5.0), ("R2", "t1", 7.0)]
    info = sorted(map(tuple, X.read_run_info(spark, [str(tmp_path / "*" / "run_info.json")]).collect()))
    assert info == [("R1", 50.0, "kallisto", "effective"), ("R2", None, "x", "none")]


def test_packages(spark, tmp_path):
    (tmp_path / "x.xml").write_text("""<SET><EXPERIMENT_PACKAGE><EXPERIMENT accession="DRX1"><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_LAYOUT><PAIRED/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN></EXPERIMENT>
<STUDY accession="DRP1"><IDENTIFIERS><EXTERNAL_ID namespace="BioProject">PRJDB1</EXTERNAL_ID></IDENTIFIERS></STUDY><SAMPLE accession="DRS1"><SAMPLE_NAME><TAXON_ID>9606</TAXON_ID><SCIENTIFIC_NAME>Homo sapiens</SCIENTIFIC_NAME></SAMPLE_NAME>
<SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG>Tissue Type (x)</TAG><VALUE>leaf</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>tissue</TAG><VALUE>b</VALUE></SAMPLE_ATTRIBUTE></SAMPLE_ATTRIBUTES></SAMPLE>
<RUN_SET><RUN accession="DRR1" total_spots="5" total_bases="50"><SRAFiles><SRAFile filename="o" supertype="Original"><Alternatives org="NCBI" url="https://o"/></SRAFile><SRAFile filename="f" supertype="Primary ETL"><Alternatives org="AWS" url="s3://f"/><Alternatives org="NCBI" url="https://f"/></SRAFile></SRAFiles></RUN><RUN accession="DRR2"/></RUN_SET></EXPERIMENT_PACKAGE></SET>""")
    rows = {r.run: r for r in X.read_packages(spark, str(tmp_path / "x.xml")).collect()}
    assert rows["DRR1"].bioproject == "PRJDB1" and rows["DRR1"].ncbi_link == "https://f" and rows["DRR2"].ncbi_link is None and rows["DRR2"].lib_layout == "paired"
    attrs = X.read_packages(spark, str(tmp_path / "x.xml")).select("run", F.explode("attributes").alias("a")).select("run", F.col("a.TAG").alias("tag"), F.col("a.VALUE").alias("value"))
    assert {(r.name, r.value) for r in X.attributes_to_columns(attrs).collect()} == {("tissue_type", "leaf"), ("sample_attribute_tissue", "b")}


def test_all_fields_of_a_package(spark, tmp_path):
    (tmp_path / "x.xml").write_text("""<SET><EXPERIMENT_PACKAGE><EXPERIMENT accession="DRX000002"><IDENTIFIERS><PRIMARY_ID>DRX000001</PRIMARY_ID></IDENTIFIERS><TITLE>an experiment</TITLE>
<STUDY_REF><IDENTIFIERS><PRIMARY_ID>DRP1</PRIMARY_ID></IDENTIFIERS></STUDY_REF><DESIGN><DESIGN_DESCRIPTION>by design</DESIGN_DESCRIPTION><LIBRARY_DESCRIPTOR><LIBRARY_NAME>L</LIBRARY_NAME><LIBRARY_STRATEGY>RNA-Seq</LIBRARY_STRATEGY>
<LIBRARY_SOURCE>TRANSCRIPTOMIC</LIBRARY_SOURCE><LIBRARY_SELECTION>cDNA</LIBRARY_SELECTION><LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH="250" NOMINAL_SDEV="25"/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR>
<SPOT_DESCRIPTOR><SPOT_DECODE_SPEC><SPOT_LENGTH>200</SPOT_LENGTH><READ_SPEC><READ_INDEX>0</READ_INDEX><READ_CLASS>Application Read</READ_CLASS><READ_TYPE>Forward</READ_TYPE><BASE_COORD>1</BASE_COORD></READ_SPEC><READ_SPEC><READ_INDEX>1</READ_INDEX></READ_SPEC></SPOT_DECODE_SPEC></SPOT_DESCRIPTOR></DESIGN>
<PLATFORM><OXFORD_NANOPORE><INSTRUMENT_MODEL>MinION</INSTRUMENT_MODEL></OXFORD_NANOPORE></PLATFORM></EXPERIMENT>
<SUBMISSION center_name="a centre" accession="DRA1"><IDENTIFIERS><PRIMARY_ID>DRA9</PRIMARY_ID><SUBMITTER_ID>sub</SUBMITTER_ID></IDENTIFIERS></SUBMISSION>
<STUDY accession="DRP1"><IDENTIFIERS><EXTERNAL_ID namespace="GEO">GSE1</EXTERNAL_ID></IDENTIFIERS><DESCRIPTOR><STUDY_TITLE>a study</STUDY_TITLE></DESCRIPTOR><STUDY_LINKS><STUDY_LINK><XREF_LINK><DB>pubmed</DB><LABEL>x</LABEL><ID>77</ID></XREF_LINK></STUDY_LINK><STUDY_LINK><XREF_LINK><LABEL>PRJNA5</LABEL><ID>5</ID></XREF_LINK></STUDY_LINK></STUDY_LINKS></STUDY>
<SAMPLE accession="DRS1"><IDENTIFIERS><PRIMARY_ID>DRS2</PRIMARY_ID><EXTERNAL_ID namespace="BioSample">SAMD1</EXTERNAL_ID><EXTERNAL_ID namespace="BioSample">SAMD2</EXTERNAL_ID></IDENTIFIERS><TITLE>a sample</TITLE><SAMPLE_NAME><TAXON_ID>9606</TAXON_ID><SCIENTIFIC_NAME>Homo sapiens</SCIENTIFIC_NAME></SAMPLE_NAME><DESCRIPTION>described</DESCRIPTION></SAMPLE>
<RUN_SET><RUN accession="DRR000001" total_spots="5" total_bases="50" size="7" published="2020-02-03 04:05:06"><SRAFiles><SRAFile supertype="Primary ETL"><Alternatives org="EBI" url="ftp://ftp.sra.ebi.ac.uk/v/r"/><Alternatives org="GCP" url="gs://g"/></SRAFile></SRAFiles></RUN></RUN_SET></EXPERIMENT_PACKAGE>
<EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX2"><PLATFORM><ILLUMINA><INSTRUMENT_MODEL>HiSeq</INSTRUMENT_MODEL></ILLUMINA></PLATFORM></EXPERIMENT><RUN_SET><RUN accession="SRR2"/></RUN_SET></EXPERIMENT_PACKAGE></SET>""")
    df = X.read_packages(spark, str(tmp_path / "x.xml"))
    rows = {r.run: r.asDict() for r in df.collect()}
    assert {c.lower() for c in X.CORE_COLUMNS} - set(df.columns) == {"sample_group", "tissue", "genotype", "sex", "age", "treatment", "source_name", "is_sampled", "is_qualified", "exclusion", "protocol"}
    want = dict(
        run="DRR000001", experiment="DRX000001", bioproject="PRJNA5", biosample="SAMD1", scientific_name="Homo sapiens", taxid="9606", sra_primary="DRA9", sra_sample="DRS2", sra_study="DRP1", published_date="2020-02-03 04:05:06",
        study_title="a study", exp_title="an experiment", sample_title="a sample", sample_description="described", design="by design", lib_name="L", lib_strategy="RNA-Seq", lib_source="TRANSCRIPTOMIC", lib_selection="cDNA",
        lib_layout="paired", nominal_length="250", nominal_sdev="25", spot_length="200", read_index="0", read_class="Application Read", read_type="Forward", base_coord="1", platform="OXFORD_NANOPORE", instrument="MinION",
        center="a centre", submitter_id="sub", pubmed_id="77", total_spots="5", total_bases="50", size="7", ncbi_link=None, aws_link=None, gcp_link="gs://g", ena_sra_link="https://ftp.sra.ebi.ac.uk/v/r",
        ddbj_sra_link=X.EXPERIMENT_ARCHIVE + "/sra/ByExp/sra/DRX/DRX000/DRX000001/DRR000001/DRR000001.sra", attributes=None,
    )
    assert rows["DRR000001"] == want
    assert {k: v for k, v in rows["SRR2"].items() if v is not None} == {"run": "SRR2", "experiment": "SRX2", "platform": "ILLUMINA", "instrument": "HiSeq"}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_reads_of_a_file_in_many_blocks(spark, tmp_path, end):
    want = [(i + 1, f"@r{i}", "ACGT" * (i % 5), "+", "I" * (4 * (i % 5))) for i in range(40)]
    (tmp_path / "a.fq").write_bytes("".join(end.join(r[1:]) + end for r in want).encode())
    (tmp_path / "cut.fastq").write_text("@r1\nAC\n+\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
    try:
        got = X.read_fastq(spark, str(tmp_path / "a.fq"))
        assert got.rdd.getNumPartitions() > 3
        assert sorted((r.ordinal, r.header, r.seq, r.plus, r.qual) for r in got.collect()) == want
        with pytest.raises(ValueError):
            X.read_fastq(spark, str(tmp_path / "*.f*q"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_reads_markers_taxonomy_and_reports(spark, tmp_path):
    import gzip

    (tmp_path / "a.fq").write_text("@r1\nAC\n+\nII\n")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("@r2\nACG\n+\nIII\n@r3\nA\n+\nI\n")
    assert sorted(r.seq for r in X.read_fastq(spark, str(tmp_path / "*.fq*")).collect()) == ["A", "AC", "ACG"]
    (tmp_path / "Homo_sapiens_busco.tsv").write_text("# c\nBusco id\tStatus\tSequence\tScore\tLength\turl\td\nb1\tComplete\tg1:1-5\t1\t1\t\tx\n")
    r = X.read_markers(spark, [str(tmp_path / "Homo_sapiens_busco.tsv")]).collect()
    assert len(r) == 1 and (r[0].sequence, r[0].orthodb_url, r[0].species) == ("g1", "-", "Homo_sapiens")
    for name, line in (("nodes", "2\t|\t1\t|\tgenus\t|\n"), ("names", "2\t|\tX\t|\t\t|\tscientific name\t|\n2\t|\ty\t|\t\t|\tacronym\t|\n"), ("merged", "7\t|\t2\t|\n")):
        (tmp_path / f"{name}.dmp").write_text(line)
    nodes, names, merged = X.read_taxonomy(spark, str(tmp_path))
    assert tuple(nodes.first()) == (2, 1, "genus") and [tuple(x) for x in names.collect()] == [(2, "X", 1)] and tuple(merged.first()) == (7, 2)
    (tmp_path / "r.tsv").write_text("run_accession\tfastq_ftp\nR1\tftp.x/a;ftp://x/b;ftp.x/a\n")
    assert X.read_archive_report(spark, str(tmp_path / "r.tsv")).first().urls == ["https://ftp.x/a", "https://x/b"]
    links = spark.createDataFrame([("R", "x_2.fq", ["u", "u"]), ("R", "x_1.fq", ["v"])], "run string, name string, urls array<string>")
    assert sorted((r.name, r.mate, r.urls) for r in X.original_file_links(links).collect()) == [("x_1.fq", 1, ["v"]), ("x_2.fq", 2, ["u"])]


def test_matrix_round_trip(spark, tmp_path):
    expr = spark.createDataFrame([("t1", "a", 1.0), ("t1", "b", 2.0), ("t2", "a", 3.0)], "target_id string, run string, value double")
    X.write_matrix(expr, str(tmp_path / "m"), ["a", "b"])
    back = X.read_expression(spark, str(tmp_path / "m"))
    assert sorted((r.target_id, r.run, r.value) for r in back.where("value is not null").collect()) == [("t1", "a", 1.0), ("t1", "b", 2.0), ("t2", "a", 3.0)]
