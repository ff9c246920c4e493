"""Queries of sources and sinks: the given tables are written as the files that a source reads, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.plans import bindings as B
from curatrix.plans.bindings import cte, query
from curatrix.session import scratch
from curatrix.sources import reads as R
from curatrix.sources import tables as X


@query(cte("meta") + " select distinct run, scientific_name, case when exclusion = '' then 'no' else exclusion end as exclusion, 'project'||pos as extra, '' as tissue from meta where run <> ''")
def read_metadata(spark, d):
    path = scratch(spark, "metadata")
    m = B.meta(spark, d).where("run <> ''").select(F.concat("run", F.lit(" ")).alias("run"), "scientific_name", "exclusion", F.concat(F.lit("project"), "pos").alias("extra"))
    m.write.csv(path, sep="\t", header=True, quote="", emptyValue="", ignoreTrailingWhiteSpace=False)
    return X.read_metadata(spark, path).select("run", "scientific_name", "exclusion", "extra", "tissue")


@query(cte("titles") + " select run, replace(title, ' ', ' ') as title, kind from titles")
def write_metadata(spark, d):
    path = scratch(spark, "metadata")
    X.write_metadata(B.titles(spark, d).select("run", F.regexp_replace("title", " ", "\t").alias("title"), "kind"), path)
    return X.read_delimited(spark, path)


@query(cte("counts") + " select target_id, run, value from counts")
def read_expression(spark, d):
    path = scratch(spark, "matrix")
    c = B.counts(spark, d)
    X.write_matrix(c, path, [r[0] for r in c.select("run").distinct().orderBy("run").collect()])
    return X.read_expression(spark, path).where("value is not null").select("target_id", "run", "value")


@query(cte("counts") + " select target_id, count(*) as n_runs, sum(value) as total from counts group by 1")
def write_matrix(spark, d):
    path = scratch(spark, "matrix")
    c = B.counts(spark, d)
    X.write_matrix(c, path, [r[0] for r in c.select("run").distinct().orderBy("run").collect()])
    return X.read_expression(spark, path).groupBy("target_id").agg(F.count("value").alias("n_runs"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


@query(cte("abundance") + " select run, target_id, length, eff_length, est_counts, tpm from abundance")
def read_abundance(spark, d):
    path = scratch(spark, "abundance")
    a = B.abundance(spark, d)
    a.select("target_id", "length", "eff_length", "est_counts", "tpm", "run").repartition("run").write.partitionBy("run").csv(path, sep="\t", header=True)
    got = X.read_abundance(spark, [f"{path}/*/*.csv"])
    return got.withColumn("run", F.regexp_replace("run", "^run=", "")).select("run", "target_id", "length", "eff_length", "est_counts", "tpm")


@query("select cast(l_suppkey as varchar) as run, round(cast(avg(l_quantity) as double), 4) as mapping_rate, case when l_suppkey % 3 = 0 then 'long' else 'kallisto' end as backend, case when l_suppkey % 5 = 0 then 'none' else 'effective' end as length_model from lineitem group by l_suppkey")
def read_run_info(spark, d):
    """A folder with an information file per run; optional fields are left out."""
    path, k = scratch(spark, "info"), F.col("l_suppkey")
    runs = B.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 4).alias("p_pseudoaligned"))
    info = F.to_json(F.struct("p_pseudoaligned", F.when(k % 3 == 0, "long").alias("quant_backend"), F.when(k % 5 == 0, "none").alias("length_model")))
    runs.select(info.alias("value"), k.alias("run")).repartition("run").write.partitionBy("run").text(path)
    got = X.read_run_info(spark, [f"{path}/*/*.txt"])
    return got.withColumn("run", F.regexp_replace("run", "^run=", ""))


@query(cte("runs") + " select run, case when pos % 4 = 0 then 'long' else 'kallisto' end as backend, case when pos % 4 = 0 then 'none' else 'effective' end as length_model from runs")
def read_quant_model(spark, d):
    path = scratch(spark, "models")
    k = F.col("pos") % 4 == 0
    B.runs(spark, d).select("run", F.when(k, "long").otherwise("").alias("backend"), F.when(k, "none").otherwise("").alias("length_model")).write.csv(path, sep="\t", header=True, emptyValue="", quote="")
    return X.read_quant_model(X.read_delimited(spark, path))


@query(cte("stats") + " select run, s.n as views from (select distinct run from stats) r left join (select run, n from stats where stage = 'view') s using (run)")
def read_stage_stats(spark, d):
    path = scratch(spark, "stage-stats")
    s = B.stats(spark, d)
    s.where("stage = 'view'").select("run", F.col("n").alias("views"), "metric").write.csv(path, sep="\t", header=True)
    stats = X.read_delimited(spark, path).withColumn("views", F.col("views").cast("long"))
    return X.merge_stage_stats(s.select("run").distinct(), stats, ["views"])


@query("with m as (select 'b'||p_partkey as busco_id, case when p_size < 20 then 'Complete' else 'Missing' end as status, case when p_partkey % 5 = 0 then '-' else 'g'||p_partkey end as sequence, 'Genus_sp'||(p_partkey % 3) as species from part) select * from m")
def read_busco_table(spark, d):
    path, k = scratch(spark, "markers"), F.col("p_partkey")
    p = B.table(spark, d, "part")
    rows = p.select(
        F.concat(F.lit("b"), k).alias("busco_id"), F.when(F.col("p_size") < 20, "Complete").otherwise("Missing").alias("status"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("g"), k, F.lit(":1-99"))).alias("sequence"),
        F.lit("1").alias("score"), F.lit("9").alias("length"), F.lit("").alias("orthodb_url"), F.col("p_name").alias("description"), F.concat(F.lit("Genus_sp"), k % 3).alias("species"),
    )
    head = rows.groupBy("species").agg(F.max(F.lit("Busco id")).alias("busco_id")).select("busco_id", *[F.lit("x").alias(c) for c in X.MARKER_COLUMNS[1:]], "species")
    rows.unionByName(head).withColumn("file", F.concat("species", F.lit("_busco.tsv"))).drop("species").repartition("file").write.partitionBy("file").csv(path, sep="\t", emptyValue="", quote="")
    got = X.read_markers(spark, [f"{path}/*/*.csv"])
    return got.select("busco_id", "status", "sequence", "species")


@query("with " + B.SQL["taxa"] + " select 'nodes' as part, count(*) as n, sum(taxid)::bigint as ids from nodes union all select 'names', count(*), sum(taxid)::bigint from names union all select 'merged', count(*), sum(old_taxid)::bigint from merged")
def read_taxonomy_dump(spark, d):
    path = scratch(spark, "taxonomy")
    nodes, names, merged = B.taxa(spark, d)
    end, bar = F.lit("\t|"), "\t|\t"
    nodes.select(F.concat(F.concat_ws(bar, "taxid", "parent_taxid", "rank"), end)).write.text(f"{path}/nodes.dmp")
    kind = F.when(F.col("is_scientific") == 1, "scientific name").otherwise("synonym")
    extra = names.select("taxid", F.lit("x").alias("name"), F.lit("").alias("u"), F.lit("acronym").alias("k"))
    names.select("taxid", "name", F.lit("").alias("u"), kind.alias("k")).unionByName(extra).select(F.concat(F.concat_ws(bar, "taxid", "name", "u", "k"), end)).write.text(f"{path}/names.dmp")
    merged.select(F.concat(F.concat_ws(bar, "old_taxid", "new_taxid"), end)).write.text(f"{path}/merged.dmp")
    parts = zip(("nodes", "names", "merged"), X.read_taxonomy(spark, path), ("taxid", "taxid", "old_taxid"))
    out = [t.agg(F.lit(k).alias("part"), F.count(F.lit(1)).alias("n"), F.sum(c).alias("ids")) for k, t, c in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(cte("reads") + " select '@'||core||'/'||coalesce(mate, 1)||'.'||ordinal as header, cast(length(replace(seq, chr(10), ' ')) as int) as n, '+' as plus from reads")
def read_fastq(spark, d):
    path = scratch(spark, "reads")
    seq = F.regexp_replace("seq", "\n", " ")
    r = B.reads(spark, d)
    record = F.concat_ws("\n", F.concat(F.lit("@"), "core", F.lit("/"), F.coalesce("mate", F.lit(1)), F.lit("."), "ordinal"), seq, F.lit("+"), F.regexp_replace(seq, ".", "I"))
    r.select(record.alias("value")).write.text(path, compression="gzip")
    return X.read_fastq(spark, f"{path}/*.gz").select("header", F.length("seq").alias("n"), "plus")


@query(cte("reads") + " select '@'||core||'/'||coalesce(mate, 1)||'.'||ordinal as header, cast(length(replace(seq, chr(10), ' ')) as int) as n, '+' as plus from reads")
def read_fastq_source(spark, d):
    """Plain files by the data source, in splits of a few records."""
    path = scratch(spark, "reads")
    seq = F.regexp_replace("seq", "\n", " ")
    record = F.concat_ws("\n", F.concat(F.lit("@"), "core", F.lit("/"), F.coalesce("mate", F.lit(1)), F.lit("."), "ordinal"), seq, F.lit("+"), F.regexp_replace(seq, ".", "I"))
    B.reads(spark, d).select(record.alias("value")).write.text(path)
    return R.scan_reads(spark, f"{path}/*.txt", ("header", "seq", "plus"), 1 << 16).select("header", F.length("seq").alias("n"), "plus")


@query("select 'R'||o_orderkey as run, case when o_orderkey % 2 = 0 then 2 else 1 end as n_urls, 'https://h/'||o_orderkey||'_1' as first from orders")
def read_archive_report(spark, d):
    path, k = scratch(spark, "report"), F.col("o_orderkey")
    one = F.concat(F.lit("h/"), k, F.lit("_1"))
    links = F.when(k % 2 == 0, F.concat_ws(";", one, F.concat(F.lit("ftp://h/"), k, F.lit("_2")), one)).otherwise(one)
    B.table(spark, d, "orders").select(F.concat(F.lit("R"), k).alias("run_accession"), links.alias("fastq_ftp")).write.csv(path, sep="\t", header=True)
    return X.read_archive_report(spark, path).select("run", F.size("urls").alias("n_urls"), F.col("urls")[0].alias("first"))


@query("select 'R'||l_orderkey||'.'||l_partkey||'.'||l_suppkey as run, k as mate, 1 as n_urls from (select distinct l_orderkey, l_partkey, l_suppkey from lineitem) cross join (values (1), (2)) t(k)")
def original_file_links(spark, d):
    li = B.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").distinct()
    run = F.concat(F.lit("R"), F.concat_ws(".", "l_orderkey", "l_partkey", "l_suppkey"))
    marks = F.when(F.col("l_orderkey") % 2 == 0, F.array(F.lit("x_R1.fq"), F.lit("x_R2.fq"))).otherwise(F.array(F.lit("b.fq"), F.lit("a.fq")))
    files = li.select(run.alias("run"), F.explode(marks).alias("name")).withColumn("urls", F.array("name", "name"))
    return X.original_file_links(files).select("run", "mate", F.size("urls").alias("n_urls"))


@query("""select 'DRR'||p_partkey as run, 'PRJ'||p_partkey as bioproject, 'SAMN'||p_partkey as biosample, case when p_partkey % 2 = 0 then 'paired' else 'single' end as lib_layout, cast(p_size as varchar) as total_spots, p_brand as tissue,
 'about '||p_name as study_title, p_name as exp_title, p_type as sample_title, 'RNA-Seq' as lib_strategy, 'lib'||p_partkey as lib_name, case when p_partkey % 3 = 0 then 'RANDOM' end as lib_selection, '2020-01-'||lpad(cast(1 + p_size % 28 as varchar), 2, '0')||' 00:00:00' as published_date,
 'ILLUMINA' as platform, p_brand as instrument, case when p_partkey % 2 = 0 then cast(p_size * 2 as varchar) end as nominal_length, cast(100 + p_size as varchar) as spot_length, 'Application Read' as read_class, 'c'||p_size as center,
 case when p_partkey % 3 = 0 then 'https://n/'||p_partkey end as ncbi_link, case when p_partkey % 3 = 1 then 'https://ftp.sra.ebi.ac.uk/'||p_partkey end as ena_sra_link from part""")
def read_sra_xml(spark, d):
    path, k = scratch(spark, "packages"), F.col("p_partkey").cast("string")
    even, third = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 3
    layout = F.struct(F.when(~even, "x").alias("SINGLE"), F.when(even, F.struct(F.lit("x").alias("_VALUE"), (F.col("p_size") * 2).cast("string").alias("_NOMINAL_LENGTH"))).alias("PAIRED"))
    library = F.struct(F.concat(F.lit("lib"), k).alias("LIBRARY_NAME"), F.lit("RNA-Seq").alias("LIBRARY_STRATEGY"), F.when(third == 0, "RANDOM").alias("LIBRARY_SELECTION"), layout.alias("LIBRARY_LAYOUT"))
    spec = F.struct((100 + F.col("p_size")).cast("string").alias("SPOT_LENGTH"), F.array(F.struct(F.lit("Application Read").alias("READ_CLASS")), F.struct(F.lit("later").alias("READ_CLASS"))).alias("READ_SPEC"))
    design = F.struct(F.struct(spec.alias("SPOT_DECODE_SPEC")).alias("SPOT_DESCRIPTOR"), library.alias("LIBRARY_DESCRIPTOR"))
    external = lambda *pairs: F.struct(F.array(*[F.struct(v.alias("_VALUE"), F.lit(n).alias("_namespace")) for v, n in pairs]).alias("EXTERNAL_ID")).alias("IDENTIFIERS")
    link = lambda org, url: F.struct(F.lit(org).alias("_org"), url.alias("_url"))
    files = F.array(
        F.struct(F.lit("Original").alias("_supertype"), F.array(link("NCBI", F.lit("https://original"))).alias("Alternatives")),
        F.struct(F.lit("Primary ETL").alias("_supertype"), F.array(F.when(third == 0, link("NCBI", F.concat(F.lit("https://n/"), k))).when(third == 1, link("EBI", F.concat(F.lit("ftp://ftp.sra.ebi.ac.uk/"), k))).otherwise(link("other", F.lit("x")))).alias("Alternatives")),
    )
    date = F.concat(F.lit("2020-01-"), F.lpad((1 + F.col("p_size") % 28).cast("string"), 2, "0"), F.lit(" 00:00:00"))
    run = F.struct(F.concat(F.lit("DRR"), k).alias("_accession"), date.alias("_published"), F.col("p_size").cast("string").alias("_total_spots"), F.struct(files.alias("SRAFile")).alias("SRAFiles"))
    B.table(spark, d, "part").select(
        F.struct(F.concat(F.lit("DRX"), k).alias("_accession"), F.col("p_name").alias("TITLE"), F.struct(F.struct(F.col("p_brand").alias("INSTRUMENT_MODEL")).alias("ILLUMINA")).alias("PLATFORM"), design.alias("DESIGN")).alias("EXPERIMENT"),
        F.struct(F.concat(F.lit("c"), F.col("p_size")).alias("_center_name")).alias("SUBMISSION"),
        F.struct(F.lit("S").alias("_accession"), external((F.lit("other"), "x"), (F.concat(F.lit("PRJ"), k), "BioProject")), F.struct(F.concat(F.lit("about "), "p_name").alias("STUDY_TITLE")).alias("DESCRIPTOR")).alias("STUDY"),
        F.struct(F.lit("B").alias("_accession"), external((F.concat(F.lit("SAMN"), k), "BioSample"), (F.lit("second"), "BioSample")), F.col("p_type").alias("TITLE"), F.struct(F.array(F.struct(F.lit("Tissue kind").alias("TAG"), F.col("p_brand").alias("VALUE"))).alias("SAMPLE_ATTRIBUTE")).alias("SAMPLE_ATTRIBUTES")).alias("SAMPLE"),
        F.struct(F.array(run).alias("RUN")).alias("RUN_SET"),
    ).write.format("xml").option("rootTag", "SET").option("rowTag", "EXPERIMENT_PACKAGE").save(path)
    p = X.read_packages(spark, path)
    tissue = X.attributes_to_columns(p.select("run", F.explode("attributes").alias("a")).select("run", F.col("a.TAG").alias("tag"), F.col("a.VALUE").alias("value"))).select("run", F.col("value").alias("tissue"))
    wanted = "study_title exp_title sample_title lib_strategy lib_name lib_selection published_date platform instrument nominal_length spot_length read_class center ncbi_link ena_sra_link"
    return p.join(tissue, "run").select("run", "bioproject", "biosample", "lib_layout", "total_spots", "tissue", *wanted.split())
