"""Scans of tabular result files into long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.functions import names as N

#: Where each tool keeps the gene and the count (negative: from the end), and rows that are no genes.
LAYOUTS = {
    "featurecounts": (0, -1, "^(#|Geneid$)"),
    "star": (0, 1, "^N_"),
    "salmon": (0, 4, "^Name$"),
}


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the name of their file, fields split at tabs, carriage returns dropped."""
    text = spark.read.text(path).select(F.rtrim(F.regexp_replace("value", "\r$", "")).alias("line"), F.col("_metadata.file_path").alias("file"))
    return text.where("line <> ''").select("file", F.split("line", "\t").alias("f"))


def sample_name(file: Column) -> Column:
    """Sample of a file: its name up to the tool's suffix, or that of a ``<sample>_salmon`` folder."""
    folder = F.regexp_extract(file, r"([^/]+)_salmon/quant\.sf$", 1)
    name = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"(\.salmon\.quant\.sf|\.featureCounts\.(txt|tsv)|\.?ReadsPerGene\.out\.tab|\.(txt|tsv|tab|sf))$", "")
    return F.when(folder != "", folder).otherwise(name)


def read_gene_counts(spark: SparkSession, path: str | list[str], tool: str) -> DataFrame:
    """``tool``, ``sample``, ``gene`` (without version) and ``n`` of one tool's count files.

    Summary, comment and header rows are left out; a count that is no number is null.
    Salmon's count column is found by its name in the header of each file.
    """
    gene, count, other = LAYOUTS[tool]
    at = lambda i: F.element_at("f", i + 1 if i >= 0 else i)
    lines = _lines(spark, path)
    rows = lines.where(~F.element_at("f", 1).rlike(other))
    if tool == "salmon":
        heads = lines.where(F.element_at("f", 1) == "Name").select("file", F.array_position("f", "NumReads").cast("int").alias("at"))
        named = rows.join(heads, "file").select("file", "f", "at")
        return named.select(F.lit(tool).alias("tool"), sample_name(F.col("file")).alias("sample"), F.substring_index(at(gene), ".", 1).alias("gene"), F.try_element_at("f", F.col("at")).try_cast("double").alias("n"))
    return rows.select(F.lit(tool).alias("tool"), sample_name(F.col("file")).alias("sample"), F.substring_index(at(gene), ".", 1).alias("gene"), at(count).try_cast("double").alias("n"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Sample metadata whose header tells the separator: tab, else semicolon without commas, else comma."""
    head = spark.read.text(path).head(1)
    line = head[0]["value"] if head else ""
    sep = "\t" if "\t" in line else ";" if ";" in line and "," not in line else ","
    return spark.read.csv(path, header=True, sep=sep)


def read_reports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Taxonomy reports: ``sample``, ``line_no``, ``pct``, ``clade_reads``, ``direct_reads``, ``rank_code``, ``tax_id``, ``name``, ``depth``.

    A report has one line per taxon, so a file is read whole to keep its order.
    Lines of fewer than six fields are left out; two blanks indent a level.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).withColumn("f", F.split("line", "\t")).where("size(f) >= 6")
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"(\.kraken2?)?(\.report)?(\.(txt|tsv))?$", "")
    number = lambda i, t: F.trim(F.col("f")[i]).try_cast(t)
    label = F.col("f")[5]
    return lines.select(name.alias("sample"), "line_no", number(0, "double").alias("pct"), number(1, "long").alias("clade_reads"), number(2, "long").alias("direct_reads"), F.trim(F.col("f")[3]).alias("rank_code"), F.trim(F.col("f")[4]).alias("tax_id"), F.trim(label).alias("name"), F.floor((F.length(label) - F.length(F.ltrim(label))) / 2).cast("int").alias("depth"))


def read_contaminants(spark: SparkSession, path: str) -> DataFrame:
    """Distinct taxon ids, one a line, as text; blank lines are left out."""
    return spark.read.text(path).select(F.trim("value").alias("tax_id")).where("tax_id <> ''").distinct()


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """``sample``, ``fastq_1``, ``fastq_2``, ``strandedness`` of a sheet with a header, as text."""
    return spark.read.csv(path, header=True).select("sample", "fastq_1", "fastq_2", "strandedness")


def read_comparisons(spark: SparkSession, path: str) -> DataFrame:
    """``comparison``, ``control``, ``treatment`` of a table of comparisons."""
    return spark.read.csv(path, header=True).select(F.col("comparison_name").alias("comparison"), F.col("control_group").alias("control"), F.col("treatment_group").alias("treatment"))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy nodes, Parquet or tab-separated with a header: ``tax_id``, ``parent_id``, ``rank``, ``name``."""
    raw = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, sep="\t")
    return raw.select(F.col("tax_id").cast("int").alias("tax_id"), F.col("parent_id").cast("int").alias("parent_id"), "rank", "name")


ABUNDANCE = ("name", "taxonomy_id", "taxonomy_lvl", "kraken_assigned_reads", "added_reads", "new_est_reads", "fraction_total_reads")


def read_abundance(spark: SparkSession, directory: str, level: str = "S") -> DataFrame:
    """Abundance tables of a folder at one level: ``sample``, ``name``, ``tax_id``, ``reads``, ``fraction``.

    Files are those that end in ``.bracken.tsv`` or, if there are none, in ``.tsv``;
    a file that lacks a column is an error.  Rows of one name add up.
    """
    def scan(pattern: str) -> DataFrame:
        return spark.read.option("pathGlobFilter", pattern).text(directory).select("value", F.col("_metadata.file_path").alias("file"))

    lines = scan("*.bracken.tsv")
    lines = scan("*.tsv") if lines.isEmpty() else lines
    rows = lines.select("file", F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f"))
    head = rows.where(F.col("f")[0] == "name").withColumnRenamed("f", "h")
    lacking = rows.select("file").distinct().join(head, "file", "left").where(~F.coalesce(F.size(F.array_except(F.array(*[F.lit(c) for c in ABUNDANCE]), "h")) == 0, F.lit(False)))
    bad = [r["file"] for r in lacking.select("file").limit(3).collect()]
    if bad:
        raise ValueError(f"columns are missing in {bad}")
    field = lambda c: F.try_element_at("f", F.array_position("h", c).cast("int"))
    named = rows.where(F.col("f")[0] != "name").join(head, "file")
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.tsv$", "")
    made = named.select(stem.alias("sample"), field("name").alias("name"), field("taxonomy_id").alias("tax_id"), F.trim(field("taxonomy_lvl")).alias("level"), field("new_est_reads").try_cast("double").alias("reads"), field("fraction_total_reads").try_cast("double").alias("fraction"))
    return made.where(F.col("level") == level).groupBy("sample", "name").agg(F.min("tax_id").alias("tax_id"), F.sum("reads").alias("reads"), F.sum("fraction").alias("fraction"))


def read_matrix(spark: SparkSession, path: str, samples: DataFrame | None = None) -> DataFrame:
    """A wide numeric matrix in long form: ``sample``, ``feature``, ``value``.

    Columns are samples when at least as many of their names are in ``samples``
    (``sample``) as names of rows, and when none are given.
    """
    wide = spark.read.csv(path, header=True, sep="," if path.lower().endswith(".csv") else "\t")
    first, *rest = wide.columns
    long = wide.select(F.col(f"`{first}`").alias("row"), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").try_cast("double").alias("value")) for c in rest])))
    by_column = True
    if samples is not None:
        known = samples.select(F.col("sample").cast("string").alias("sample")).distinct()
        names = known.withColumn("in_columns", F.col("sample").isin(*rest))
        rows = wide.select(F.col(f"`{first}`").alias("sample")).distinct().withColumn("in_rows", F.lit(True))
        r = names.join(rows, "sample", "left").agg(F.count_if("in_columns"), F.count_if("in_rows")).first()
        by_column = r[0] >= r[1]
    return long.select(F.col("column" if by_column else "row").alias("sample"), F.col("row" if by_column else "column").alias("feature"), "value")


def read_genes(spark: SparkSession, path: str, feature: str = "exon", attribute: str = "gene_id") -> DataFrame:
    """Intervals of an annotation file: ``gene``, ``contig``, ``start``, ``end``, ``strand`` of one kind of feature."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f")).where((F.size("f") >= 9) & (F.col("f")[2] == feature))
    gene = F.regexp_extract(F.col("f")[8], f'{attribute}[ =]"?([^";]+)', 1)
    return rows.select(gene.alias("gene"), F.col("f")[0].alias("contig"), F.col("f")[3].try_cast("long").alias("start"), F.col("f")[4].try_cast("long").alias("end"), F.col("f")[6].alias("strand")).where("gene <> ''")


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """``gene``, ``symbol`` and ``position``, the order of lines, of a table of ids and symbols."""
    raw = spark.read.csv(path, header=True, sep="," if path.lower().endswith(".csv") else "\t")
    return raw.select(F.col(raw.columns[0]).alias("gene"), F.col(raw.columns[1]).alias("symbol"), F.monotonically_increasing_id().alias("position"))


def read_gene_sets(spark: SparkSession, path: str) -> DataFrame:
    """``term``, ``ontology``, ``gene`` of a table of gene sets."""
    return spark.read.csv(path, header=True, sep="," if path.lower().endswith(".csv") else "\t").select(F.col("term_id").alias("term"), "ontology", F.col("gene_id").alias("gene"))


def read_annotation(spark: SparkSession, path: str, decimals: tuple[str, ...] = ()) -> DataFrame:
    """Annotation separated by semicolons, all columns as text; those of ``decimals`` it has become numbers, whose sign may be a comma."""
    raw = spark.read.csv(path, header=True, sep=";")
    return raw.withColumns({c: N.decimal_comma(F.col(c)) for c in decimals if c in raw.columns})


def _whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")


def read_trimming_reports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Counts of trimming reports, a page of text each: ``name``, ``mate`` and five figures, 0 where one is missing."""
    def found(pattern: str, group: int, kind: str) -> Column:
        text = F.replace(F.regexp_extract("value", pattern, group), F.lit(","), F.lit(""))
        return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind))

    name = F.regexp_replace(F.regexp_replace("file", r"_trimming_report\.txt$", ""), r"(\.fastq\.gz|\.fq\.gz)$", "")
    return _whole_files(spark, path).select(
        F.regexp_replace(name, r"_R[12]_\d+$", "").alias("name"), F.when(F.contains("file", F.lit("_R1_")), "R1").otherwise("R2").alias("mate"),
        found(r"Total reads processed:\s+([\d,]+)", 1, "long").alias("total_reads"), found(r"Reads with adapters:\s+[\d,]+\s+\(([\d.]+)%\)", 1, "double").alias("adapters_pct"),
        found(r"Reads written \(passing filters\):\s+([\d,]+)\s+\(([\d.]+)%\)", 2, "double").alias("written_pct"), found(r"Quality-trimmed:\s+([\d,]+)\s+bp\s+\(([\d.]+)%\)", 1, "long").alias("quality_bp"),
        found(r"Total written \(filtered\):\s+[\d,]+\s+bp\s+\(([\d.]+)%\)", 1, "double").alias("bases_pct"),
    )


def read_rrna_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``sample``, ``total``, ``rrna`` and ``non_rrna`` reads of screening logs; a count that is missing follows from the others.

    Terminal codes are dropped and the last mention of a count holds.  Logs without a
    total are left out.
    """
    plain = F.regexp_replace("value", r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])", "")

    def last(pattern: str) -> Column:
        return F.replace(F.try_element_at(F.regexp_extract_all("t", F.lit(pattern), F.lit(1)), F.lit(-1)), F.lit(","), F.lit("")).try_cast("long")

    rows = _whole_files(spark, path).select(F.regexp_replace(F.regexp_replace("file", r"_ribodetector\.log$", ""), r"\.log$", "").alias("sample"), plain.alias("t"))
    raw = rows.select("sample", last(r"(?i)(?:Processed|Total reads processed:?)\s+([\d,]+)").alias("total"), last(r"(?i)(?:Detected(?=\s+[\d,]+\s+rRNA)|rRNA reads:?)\s+([\d,]+)").alias("r"), last(r"(?i)Detected\s+([\d,]+)\s+non-rRNA").alias("n")).where("total is not null")
    none = F.lit(0).cast("long")
    return raw.select("sample", "total", F.coalesce("r", F.col("total") - F.col("n"), none).alias("rrna"), F.coalesce("n", F.col("total") - F.col("r"), none).alias("non_rrna"))


def list_artifacts(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``path``, ``file`` and ``size_mb`` of files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"))


def read_pairs(files: DataFrame) -> DataFrame:
    """First and second mates among ``path``s: ``sample``, ``fastq_1``, ``fastq_2``; files without a mate give nothing.

    Trimmed files end in ``_1_val_1.fq.gz`` or ``.fastq.gz``, raw ones in
    ``_R1_001.fastq.gz``.  A raw file's sample is what precedes ``_S`` and a digit,
    with the folder's name unless that is the same or ``test_data``.
    """
    file = F.element_at(F.split("path", "/"), -1)
    folder = F.try_element_at(F.split("path", "/"), F.lit(-2))
    trimmed, raw = F.col("path").rlike(r"_1_val_1\.(fq|fastq)\.gz$"), F.col("path").endswith("_R1_001.fastq.gz")
    mate = F.when(trimmed, F.regexp_replace("path", r"_1_val_1\.(fq|fastq)\.gz$", "_2_val_2.$1.gz")).otherwise(F.regexp_replace("path", r"_R1_001\.fastq\.gz$", "_R2_001.fastq.gz"))
    base = F.regexp_replace(file, "_S[0-9].*", "")
    own = F.when((folder != base) & ~folder.isin("test_data", "."), F.concat_ws("_", base, folder)).otherwise(F.regexp_replace(file, r"_R1_001\.fastq\.gz$", ""))
    sample = F.when(trimmed, F.regexp_replace(file, r"_[12]_val_[12]\.f.*$", "")).otherwise(own)
    first = files.where(trimmed | raw).select(sample.alias("sample"), F.col("path").alias("fastq_1"), mate.alias("fastq_2"))
    return first.join(files.select(F.col("path").alias("fastq_2")).distinct(), "fastq_2", "left_semi").select("sample", "fastq_1", "fastq_2", F.lit("unstranded").alias("strandedness"))


def keyed_counts(table: DataFrame, gene: str, count: str, sample: str) -> DataFrame:
    """Two columns of a table as ``gene`` and a column named by the sample."""
    return table.select(F.col(f"`{gene}`").alias("gene"), F.col(f"`{count}`").alias(sample))
