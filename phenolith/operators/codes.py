"""Definition catalogue and code tables.

A definition directory becomes two DataFrames:

* the **catalogue** - one row per definition file, metadata columns plus a nested ``definitions`` array;
* the **code table** - one row per (definition, field, code entry), with the field's position in the
  file and its time qualifier as columns.

From the code table the **match table** is derived: codes normalised per field (first five characters of
Read codes, dots removed elsewhere), restricted to what the extractors use (``any`` everywhere,
``prevalent`` on the three fields that honour it), de-duplicated, and - for prefix-matched fields - reduced
to a *minimal cover* so that a record matches at most once per (definition, field, type), exactly like one
anchored regular-expression alternation. The match table is bounded by the size of the definition corpus
(not by the data) and is the broadcast side of every match join; :func:`broadcast_if_small` checks it.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X

DEFAULT_DEFINITIONS = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data", "definitions")

VALUE_STRUCT = "struct<code:string, value:string, ontology:string, type:string, group:string>"
FIELD_STRUCT = (
    "struct<field:string, field_id:int, pos:int, desc:string, qual_type:string, qual_field:int, "
    f"field_type:string, values:array<{VALUE_STRUCT}>>"
)
CATALOGUE_SCHEMA = (
    "file string, phenotype string, group string, is_cancer string, is_adult string, variable_name string, "
    "gender array<string>, authors string, uuid string, priority string, ontologies map<string,string>, "
    "short_desc string, long_desc string, complex_logic string, created_by string, date_created string, "
    f"definitions array<{FIELD_STRUCT}>"
)

# a code table of at most this many bytes is broadcast; beyond it the join shuffles
BROADCAST_BYTES = 64 << 20
#: Codes of a list that is pushed to the scan as a lookup, at most (values past Spark's inFilterThreshold become a range).
POINT_CODES = 200
#: Prefix codes that are listed in a condition on the records, at most (about a megabyte of plan).
LISTED_PREFIXES = 20_000


class UnknownPhenotypeError(ValueError):
    pass


# ----------------------------------------------------------------------------------------------
# Load definitions
# ----------------------------------------------------------------------------------------------

def _definition_parser(meta_keys: tuple[str, ...], code_keys: tuple[str, ...], columns: list[str]):
    """The per-batch YAML parser for ``mapInPandas``. Everything it needs is inside the closure, so it is
    shipped to the Python workers by value (they need no copy of this package)."""

    def parse_batches(batches):
        import json

        import pandas as pd
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def text(v):
            if v is None:
                return None
            if isinstance(v, (dict, list)):
                return json.dumps(v, sort_keys=True, default=str)
            return str(v)

        def as_int(v):
            try:
                return int(v)
            except (TypeError, ValueError):
                return None

        def parse(path, body):
            doc = yaml.load(body, Loader=loader) or {}
            meta = doc.get("metadata") or {}
            row = {"file": path}
            for k in meta_keys:
                row[k] = text(meta.get(k))
            gender = meta.get("gender")
            row["gender"] = [str(g) for g in gender] if isinstance(gender, list) else ([str(gender)] if gender else None)
            onto = meta.get("ontologies")
            row["ontologies"] = {str(k): text(v) for k, v in onto.items()} if isinstance(onto, dict) else None
            fields = []
            for pos, (key, fbody) in enumerate((doc.get("definitions") or {}).items()):
                fbody = fbody or {}
                fmeta = fbody.get("metadata") or {}
                qual = fmeta.get("time_qualifier") or {}
                fields.append({
                    "field": str(key), "field_id": as_int(key), "pos": pos, "desc": text(fmeta.get("desc")),
                    "qual_type": text(qual.get("type")), "qual_field": as_int(qual.get("field_id")),
                    "field_type": text(fmeta.get("type")),
                    "values": [{k: text(v.get(k)) for k in code_keys} for v in fbody.get("values") or []],
                })
            row["definitions"] = fields
            return row

        for pdf in batches:
            yield pd.DataFrame([parse(p, t) for p, t in zip(pdf["path"], pdf["value"])], columns=columns)

    return parse_batches


def _catalogue_columns() -> list[str]:
    # top-level "name type" pairs of CATALOGUE_SCHEMA (types may contain commas inside <>)
    out, depth, cur = [], 0, ""
    for ch in CATALOGUE_SCHEMA:
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    out.append(cur.strip())
    return out


def load_catalogue(spark: SparkSession, path: str = DEFAULT_DEFINITIONS) -> DataFrame:
    """Every ``*.yaml`` under ``path`` -> one catalogue row; missing optional metadata is NULL."""
    files = (
        spark.read.text(path, wholetext=True, pathGlobFilter="*.yaml")
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    columns = [c.split(" ")[0] for c in _catalogue_columns()]
    parser = _definition_parser(C.METADATA_FIELDS + C.METADATA_OPTIONAL_FIELDS, C.CODE_FIELDS, columns)
    return files.mapInPandas(parser, CATALOGUE_SCHEMA)


def catalogue_metadata(catalogue: DataFrame) -> DataFrame:
    """The catalogue as the reference shows it: metadata columns plus the optional ones."""
    return catalogue.select(*C.METADATA_FIELDS, *C.METADATA_OPTIONAL_FIELDS)


# ----------------------------------------------------------------------------------------------
# Selecting definitions
# ----------------------------------------------------------------------------------------------

def select_phenotypes(spark: SparkSession, catalogue: DataFrame, names: Iterable[str],
                      db: str = C.DATABASES[0]) -> tuple[DataFrame, DataFrame]:
    """(selected catalogue rows, unknown requested names) via semi / anti joins."""
    if db not in C.DATABASES:
        raise ValueError(f"unknown database {db!r}; expected one of {C.DATABASES}")
    request = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "variable_name string")
    selected = catalogue.join(request, "variable_name", "left_semi")
    unknown = request.join(catalogue.select("variable_name"), "variable_name", "left_anti")
    return selected, unknown


def require_phenotypes(spark: SparkSession, catalogue: DataFrame, names: Iterable[str],
                       db: str = C.DATABASES[0]) -> DataFrame:
    """C2 with the reference's error: any unknown name raises."""
    selected, unknown = select_phenotypes(spark, catalogue, names, db)
    missing = [r.variable_name for r in unknown.collect()]  # bounded by the request list
    if missing:
        raise UnknownPhenotypeError(f"phenotype(s) not found: {sorted(missing)}")
    return selected


def is_valid_phenotype(catalogue: DataFrame, name: str) -> bool:
    return catalogue.where(F.col("variable_name") == name).limit(1).count() == 1


def categories(catalogue: DataFrame) -> DataFrame:
    """Distinct groups."""
    return catalogue.select("group").distinct()


def phenotypes_by_category(catalogue: DataFrame, category: str) -> DataFrame:
    """C9."""
    return catalogue.where(F.col("group") == category).select("variable_name")


def all_phenotypes(catalogue: DataFrame, include_cancer: bool = True, include_neonatal: bool = True) -> DataFrame:
    """All definitions, or those marked as no cancer (is_cancer '0') and as adult (is_adult '1')."""
    df = catalogue
    if not include_cancer:
        df = df.where(F.col("is_cancer") == "0")
    if not include_neonatal:
        df = df.where(F.col("is_adult") == "1")
    return df


def complex_phenotypes(catalogue: DataFrame) -> DataFrame:
    """C11."""
    return catalogue.where(F.col("complex_logic").isNotNull()).select("variable_name")


def flags(catalogue: DataFrame) -> DataFrame:
    """C4: is_cancer / is_biomarker / is_complex per definition."""
    return catalogue.select(
        "variable_name",
        F.coalesce(X.try_cast(F.col("is_cancer"), "int") != 0, F.lit(False)).alias("is_cancer"),
        F.col("variable_name").isin(*C.BIOMARKER_NAMES).alias("is_biomarker"),
        F.col("complex_logic").isNotNull().alias("is_complex"),
    )


# ----------------------------------------------------------------------------------------------
# Code table and field views
# ----------------------------------------------------------------------------------------------

def definition_fields(catalogue: DataFrame) -> DataFrame:
    """Non-empty fields per definition in file order (``limits`` never listed)."""
    return (
        catalogue.select("variable_name", F.explode("definitions").alias("d"))
        .where((F.size("d.values") > 0) & (F.col("d.field") != "limits"))
        .select("variable_name", F.col("d.field").alias("field"), F.col("d.field_id").alias("field_id"),
                F.col("d.pos").alias("pos"), F.col("d.qual_type").alias("qual_type"),
                F.col("d.qual_field").alias("qual_field"), F.col("d.field_type").alias("field_type"))
    )


def field_definition(catalogue: DataFrame, phenotype: str, field: str | int) -> DataFrame:
    """One field's definition (metadata + values) if the definition lists it with values, else no row."""
    return (catalogue.where(F.col("variable_name") == phenotype)
            .select(F.explode("definitions").alias("d"))
            .where((F.col("d.field") == str(field)) & (F.size("d.values") > 0) & (F.col("d.field") != "limits"))
            .select("d.*"))


def age_field_id(catalogue: DataFrame, phenotype: str, field: str | int) -> int:
    """The age field qualifying a field; a field without an age qualifier is an error."""
    rows = field_definition(catalogue, phenotype, field).select("qual_type", "qual_field").collect()  # 0/1 row
    if not rows or rows[0].qual_type != "age" or rows[0].qual_field is None:
        raise ValueError(f"{phenotype}: field {field} has no age qualifier")
    return int(rows[0].qual_field)


def code_table(catalogue: DataFrame, standard_only: bool = False) -> DataFrame:
    """One row per code entry; qualifier and position carried as columns.

    ``standard_only`` reproduces the reference's table (standard, non-empty fields only)."""
    df = (
        catalogue.select("variable_name", "complex_logic", F.explode("definitions").alias("d"))
        .where(F.col("d.field") != "limits")
        .select(
            F.col("variable_name").alias("phenotype"),
            F.col("complex_logic").isNotNull().alias("is_complex"),
            F.col("d.field").alias("field"), F.col("d.field_id").alias("field_id"), F.col("d.pos").alias("pos"),
            F.col("d.qual_type").alias("qual_type"), F.col("d.qual_field").alias("qual_field"),
            F.col("d.field_type").alias("field_type"),
            F.explode("d.values").alias("v"),
        )
        .select("phenotype", "is_complex", "field", "field_id", "pos", "qual_type", "qual_field", "field_type",
                "v.code", "v.value", "v.ontology", "v.type", "v.group")
    )
    if standard_only:
        df = df.where(F.col("field_id").isin(*C.STANDARD_FIELDS))
    return df


def normalised_code(field_id: Column, code: Column) -> Column:
    """GP codes keep their first five characters, all others lose their dots."""
    return F.when(field_id == C.F_GP_CLINICAL, F.substring(code, 1, 5)).otherwise(F.regexp_replace(code, r"\.", ""))


def field_values(codes: DataFrame, phenotype: str, field_id: int, type_: str = "any") -> DataFrame:
    """Normalised, distinct codes of one field of one definition and one type."""
    return (
        codes.where((F.col("phenotype") == phenotype) & (F.col("field_id") == field_id) & (F.col("type") == type_))
        .select(normalised_code(F.col("field_id"), F.col("code")).alias("code"))
        .distinct()
    )


def prescription_codes(codes: DataFrame) -> DataFrame:
    """Prescription codes per ontology; definitions whose 42039 field is empty are absent (NULL)."""
    return (
        codes.where(F.col("field_id") == C.F_GP_PRESCRIPTIONS)
        .groupBy("phenotype")
        .pivot("ontology", list(C.PRESCRIPTION_ONTOLOGIES))
        .agg(F.collect_list("code"))  # bounded by the definition file, not by data
    )


# ----------------------------------------------------------------------------------------------
# Match table (the broadcast side of every extraction join)
# ----------------------------------------------------------------------------------------------

def _extracted_entries(codes: DataFrame) -> DataFrame:
    """Entries the extraction loop uses: complex definitions, SNOMED / prescriptions, empty and unknown
    types are dropped; prevalent entries only on the three fields that honour them (Q7)."""
    return codes.where(
        ~F.col("is_complex")
        & F.col("field_id").isNotNull()
        & (F.col("field_id") != C.F_GP_PRESCRIPTIONS)
        & (
            (F.col("type") == "any")
            | ((F.col("type") == "prevalent") & F.col("field_id").isin(*C.PREVALENT_FIELDS))
        )
    )


def match_kind(field_id: Column, field_type: Column) -> Column:
    """prefix / exact / biomarker (no code filter), decided per field."""
    return (
        F.when(F.coalesce(field_type == "biomarker", F.lit(False)), F.lit("biomarker"))
        .when(field_id.isin(*C.PREFIX_FIELDS), F.lit("prefix"))
        .otherwise(F.lit("exact"))
    )


def match_table(codes: DataFrame) -> DataFrame:
    """Normalised, de-duplicated codes with their match kind; prefix codes reduced to a minimal cover.

    Columns: phenotype, field_id, type, code (upper-case for prefix fields), match, code_len,
    qual_type, qual_field."""
    base = (
        _extracted_entries(codes)
        .select(
            "phenotype", "field_id", "type", "qual_type", "qual_field",
            match_kind(F.col("field_id"), F.col("field_type")).alias("match"),
            normalised_code(F.col("field_id"), F.col("code")).alias("code"),
        )
        .where(F.col("code").isNotNull() & (F.length("code") > 0))  # an empty list matches nothing (Q8)
        .withColumn("code", F.when(F.col("match") == "prefix", F.upper("code")).otherwise(F.col("code")))
        .withColumn("code", F.when(F.col("match") == "biomarker", F.lit(None).cast("string")).otherwise(F.col("code")))
        .distinct()
    )
    prefix = base.where(F.col("match") == "prefix")
    # a prefix code is redundant when one of its own proper prefixes is also listed for the same
    # (definition, field, type): generate the proper prefixes and anti-join them away (equi-joins only)
    proper = (
        prefix.select("phenotype", "field_id", "type", "code",
                      F.explode(F.sequence(F.lit(1), F.length("code") - 1)).alias("k"))
        .where((F.col("k") >= 1) & (F.col("k") < F.length("code")))
        .select("phenotype", "field_id", "type", "code", F.substring("code", 1, F.col("k")).alias("p"))
    )
    redundant = proper.join(
        prefix.select("phenotype", "field_id", "type", F.col("code").alias("p")),
        ["phenotype", "field_id", "type", "p"], "left_semi",
    ).select("phenotype", "field_id", "type", "code")
    cover = prefix.join(redundant, ["phenotype", "field_id", "type", "code"], "left_anti")
    return (
        base.where(F.col("match") != "prefix").unionByName(cover)
        .withColumn("code_len", F.length("code"))
    )


@dataclass(frozen=True, eq=False)
class MatchInfo:
    """Facts about a match table the plans need on the driver, gathered by one aggregate (all bounded by
    the definition corpus: a row count, a few code lengths, the fields in use)."""

    n_rows: int
    n_bytes: int
    prefix_lengths: tuple[int, ...]
    fields: tuple[int, ...]
    qual_fields: tuple[int, ...]
    fields_by_kind: dict[str, tuple[int, ...]] | None = None
    #: The GP codes, where they are few enough to be looked up (at most ``POINT_CODES``).
    gp_codes: tuple[str, ...] | None = None
    #: The (field_id, code) of the prefix fields, where they are few enough to be listed (at most ``LISTED_PREFIXES``).
    prefix_codes: tuple[tuple[int, str], ...] | None = None

    def kind_fields(self, kind: str) -> tuple[int, ...]:
        """Fields with codes of one match kind (exact / prefix / biomarker)."""
        return (self.fields_by_kind or {}).get(kind, ())

    @property
    def broadcastable(self) -> bool:
        return self.n_bytes <= BROADCAST_BYTES


def match_info(matches: DataFrame) -> MatchInfo:
    r = matches.agg(
        F.count(F.lit(1)).alias("n"), table_bytes(matches).alias("bytes"),
        F.sort_array(F.collect_set(F.when(F.col("match") == "prefix", F.col("code_len")))).alias("lens"),
        F.sort_array(F.collect_set("field_id")).alias("fields"),
        F.sort_array(F.collect_set("qual_field")).alias("quals"),
        *[F.sort_array(F.collect_set(F.when(F.col("match") == k, F.col("field_id")))).alias(k)
          for k in ("exact", "prefix", "biomarker")],
        F.collect_set(F.when((F.col("match") == "exact") & (F.col("field_id") == C.F_GP_CLINICAL), F.col("code"))).alias("gp"),
        F.collect_set(F.when(F.col("match") == "prefix", F.struct("field_id", "code"))).alias("listed"),
    ).withColumns({"gp": F.when(F.size("gp") <= POINT_CODES, F.sort_array("gp")),
                   "listed": F.when(F.size("listed") <= LISTED_PREFIXES, F.sort_array("listed"))}).first()
    return MatchInfo(int(r.n), int(r.bytes), tuple(int(x) for x in r.lens), tuple(int(x) for x in r.fields),
                     tuple(int(x) for x in r.quals),
                     {k: tuple(int(x) for x in r[k]) for k in ("exact", "prefix", "biomarker")},
                     None if r.gp is None else tuple(r.gp),
                     None if r.listed is None else tuple((int(f), c) for f, c in r.listed))


def may_match(info: MatchInfo, field: str = "field_id", value: str = "field_value") -> Column:
    """Whether a record's value starts with a prefix code of its field, whatever the case: what joins the matched values
    (:func:`match_values`), as a plain condition. Spark evaluates it in the scan, so that records without a hit are not
    shuffled by the joins that make or complete them. Always true where the codes are too many to be listed."""
    if info.prefix_codes is None:
        return F.lit(True)
    listed: dict[int, dict[int, list[str]]] = {}
    for f, code in info.prefix_codes:
        listed.setdefault(f, {}).setdefault(len(code), []).append(code)
    folded, found = F.upper(F.col(value)), F.lit(False)
    for f, by_length in listed.items():
        starts = F.lit(False)
        for k, codes in by_length.items():
            starts = starts | F.substring(folded, 1, k).isin(*codes)
        found = found | ((F.col(field) == f) & starts)
    return found


def table_bytes(df: DataFrame) -> Column:
    """Aggregate: about the bytes of ``df``'s rows (text as it is, 16 a value, 64 a row)."""
    text = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in df.dtypes if t == "string"]
    row = F.lit(64 + 16 * len(df.columns))
    for t in text:
        row = row + t
    return F.coalesce(F.sum(row), F.lit(0)).cast("long")


def broadcast_if_small(df: DataFrame, n_bytes: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a table only after checking its size in bytes; otherwise leave the join to AQE. ``n_bytes`` is a known upper
    bound (e.g. of the unfiltered match table)."""
    size = df.agg(table_bytes(df)).first()[0] if n_bytes is None else n_bytes
    return F.broadcast(df) if size <= limit else df


def slice_marks(matches: DataFrame) -> dict[tuple[str, int], str]:
    """(phenotype, field_id) -> mark of the content of its codes, whatever their order (one entry per slice: bounded by the
    definitions)."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in ("type", "code", "match", "qual_type", "qual_field")])
    other = F.xxhash64(F.lit("second"), row)
    marked = matches.groupBy("phenotype", "field_id").agg(F.count("*").alias("n"), F.bit_xor(row).alias("a"), F.bit_xor(other).alias("b"))
    return {(r.phenotype, int(r.field_id)): f"{r.n}:{r.a & (1 << 64) - 1:016x}{r.b & (1 << 64) - 1:016x}" for r in marked.collect()}


def match_values(values: DataFrame, matches: DataFrame, info: MatchInfo) -> DataFrame:
    """field_id, field_value, phenotype, type, qual_type, qual_field: each distinct value of a prefix-matched field once for
    every (definition, type) with a code that it starts with, whatever the case. Only values are expanded into their
    prefixes (of the code lengths in use); records then join by value."""
    columns = "field_id int, field_value string, phenotype string, type string, qual_type string, qual_field int"
    if not info.prefix_lengths:
        return matches.sparkSession.createDataFrame([], columns)
    folded = F.upper("field_value")
    prefixes = F.array(*[F.when(F.length(folded) >= k, F.substring(folded, 1, k)) for k in info.prefix_lengths])
    probes = values.where(F.col("field_id").isin(*info.kind_fields("prefix"))).select(
        F.col("field_id").cast("int").alias("field_id"), "field_value", F.explode(prefixes).alias("code")).where(F.col("code").isNotNull())
    codes = matches.where(F.col("match") == "prefix").select("field_id", "code", "phenotype", "type", "qual_type", "qual_field")
    return probes.join(broadcast_if_small(codes, info.n_bytes), ["field_id", "code"]).drop("code")


def lint_unextracted(codes: DataFrame) -> DataFrame:
    """Q7 lint: code entries the extraction never uses, with the reason."""
    reason = (
        F.when(F.col("is_complex"), F.lit("complex definition"))
        .when(F.col("field_id").isNull(), F.lit("non-numeric field"))
        .when(F.col("field_id") == C.F_GP_PRESCRIPTIONS, F.lit("prescriptions are not extracted"))
        .when(~F.col("type").isin("any", "prevalent") | F.col("type").isNull(), F.lit("unknown type"))
        .when((F.col("type") == "prevalent") & ~F.col("field_id").isin(*C.PREVALENT_FIELDS),
              F.lit("prevalent code on a field without prevalent extraction"))
        .when(~F.col("field_id").isin(*C.STANDARD_FIELDS) & F.col("qual_type").isNull()
              & F.coalesce(F.col("field_type") != "biomarker", F.lit(True)),
              F.lit("non-standard field without time qualifier"))
    )
    return codes.select("phenotype", "field", "code", "type", reason.alias("reason")).where(F.col("reason").isNotNull())
