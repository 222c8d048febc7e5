"""End-to-end job: workbooks in a folder -> registers -> authoritative table.

``registers_from_rows`` is the relational core (header inference, canonical
projection, typed values, locale vote, normalisation); ``run`` wires the
workbook source, linkage, consolidation, reports and sinks together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.functions import dates as D
from regfuse.functions import numbers as N
from regfuse.functions.constants import CANONICAL_FIELDS, COLUMN_ALIASES, DATASET_PATTERNS, MINISTRY_RULES
from regfuse.operators import consolidate, deck, headers as H, reports
from regfuse.operators.joins import evaluated_once, join_small
from regfuse.operators.linkage import unlinked_recommended
from regfuse.operators.register import standardize
from regfuse.operators.rowid import cell_order_key, dense_row_ids
from regfuse.session import materialize, scratch
from regfuse.sources import sinks, workbook as W

TEXT_FIELDS = ["rut", "codigo", "empresa", "ministerio_evaluador", "regimen", "tramo"]
DATE_FIELDS = ["fecha_presentado", "fecha_recomendado"]


@dataclass
class Inference:
    sheets: DataFrame  # a row per sheet, see headers.sheets
    chosen: DataFrame  # a row per (file, dataset), with the chosen sheet's mapping


def infer(rows: DataFrame, files: DataFrame, aliases: dict[str, list[str]] = COLUMN_ALIASES) -> Inference:
    """Header row, column mapping and best sheet for every (file, dataset).

    ``files``: (source_path, dataset, ...); their other columns are kept in ``chosen``."""
    sheets = H.sheets(rows, aliases)
    return Inference(sheets, H.choose_sheets(sheets, files))


def typed_values(cc: DataFrame, locale: str = "auto") -> DataFrame:
    """Canonical cells -> raw typed values per field.

    Text fields: the cell's text form.  Dates: date cells, serial numbers,
    or text parsed in d-m-y / y-m-d / m-d-y order.  Amount: numbers as is,
    text by the per-sheet locale vote (``locale='auto'``) or a fixed locale."""
    out = cc
    cols = {f"v_{f}": H.cell_text(f"c_{f}") for f in TEXT_FIELDS}
    for f in DATE_FIELDS:
        c = F.col(f"c_{f}")
        cols[f"_dt_{f}"] = F.when(c.getField("cell_type") == "text", c.getField("text"))
    out = out.withColumns(cols)
    for f in DATE_FIELDS:
        epoch = D.epoch_of("date1904")
        out = D.with_parsed_date(out, f"_dt_{f}", f"_dp_{f}", epoch)
        c = F.col(f"c_{f}")
        t = c.getField("cell_type")
        out = out.withColumn(
            f"v_{f}",
            F.when(t == "date", F.to_date(c.getField("ts")))
            .when(t == "number", D.serial_to_date(c.getField("num"), epoch))
            .otherwise(F.col(f"_dp_{f}")),
        ).drop(f"_dt_{f}", f"_dp_{f}")
    m = F.col("c_monto_ui")
    out = out.withColumn("_m_text", F.when(m.getField("cell_type").isin("text", "bool"), m.getField("text")))
    if locale == "auto":
        # one vote per sheet
        vote = N.locale_vote(out.where(F.col("_m_text").isNotNull()), H.SHEET_KEY, "_m_text")
        out = join_small(out, vote.select(*H.SHEET_KEY, "locale"), H.SHEET_KEY, "left")
    else:
        out = out.withColumn("locale", F.lit(locale))
    parsed = N.parse_number_with_vote("_m_text", "locale")
    out = out.withColumn(
        "v_monto_ui", F.when(m.getField("cell_type") == "number", m.getField("num")).otherwise(parsed)
    )
    return evaluated_once(out.drop("_m_text", "locale"), [f"v_{f}" for f in CANONICAL_FIELDS],
                          ["source_path", "source_sheet", "header_row", "row_idx", "dataset", "file_rank"])


def register_rows(rows: DataFrame, chosen: DataFrame, locale: str = "auto", ministry_rules=MINISTRY_RULES) -> DataFrame:
    """Rows of all workbooks -> canonical register rows with their ``dataset``.

    ``chosen``: see ``infer``, with ``file_rank``.  The register's ``_order``
    is ``file_rank << 32 | row`` - file order then sheet order, one bigint."""
    v = typed_values(H.canonical_cells(rows, chosen), locale)
    return standardize(
        v,
        **{f: F.col(f"v_{f}") for f in CANONICAL_FIELDS},
        source_file=W.base_name("source_path"),
        source_path=F.col("source_path"),
        source_sheet=F.col("source_sheet"),
        source_header_row=F.col("header_row"),
        source_row=F.col("row_idx"),
        order=cell_order_key("file_rank", "row_idx"),
        extra={"dataset": F.col("dataset")},
        ministry_rules=ministry_rules,
    )


def by_dataset(register: DataFrame) -> dict[str, DataFrame]:
    """{dataset: register} of ``register_rows``."""
    return {name: register.where(F.col("dataset") == name).drop("dataset") for name in ("presentados", "recomendados")}


def registers_from_rows(rows: DataFrame, files: DataFrame, aliases: dict[str, list[str]] = COLUMN_ALIASES,
                        locale: str = "auto", ministry_rules=MINISTRY_RULES) -> tuple[dict[str, DataFrame], Inference]:
    """Rows of all workbooks -> {dataset: canonical register} (+ inference tables).

    ``files``: (source_path, dataset, file_rank)."""
    inf = infer(rows, files, aliases)
    return by_dataset(register_rows(rows, inf.chosen, locale, ministry_rules)), inf


def with_row_ids(register: DataFrame, id_col: str) -> DataFrame:
    """Rows in file order with dense 1..n ids (published with the normalised tables)."""
    return dense_row_ids(register, ["_order"], id_col).orderBy(id_col)


def run(spark: SparkSession, input_dir: str, output_dir: str | None = None, fmt: str = "csv",
        locale: str = "auto", aliases: dict[str, list[str]] | None = None, ministry_rules=MINISTRY_RULES,
        patterns: dict[str, str] | None = None, atomic: bool = False) -> dict[str, DataFrame]:
    """The batch job: discover, decode, infer, normalise, link, consolidate,
    report, write.  Returns the published tables, read back from ``output_dir``.

    ``aliases`` ({field: header words}) replaces the default catalogue,
    ``ministry_rules`` and ``patterns`` (file name -> dataset) theirs.
    ``atomic``: publish all tables by one manifest (``sinks.publish``) instead
    of a folder each.  Intermediate tables are removed at the end."""
    output_dir = output_dir or input_dir.rstrip("/") + "/processed"
    patterns = patterns or DATASET_PATTERNS
    with scratch(spark):
        inv = W.inventory(spark, input_dir, output_dir, patterns)
        files = W.selected_files(inv)
        W.require_datasets(files, patterns)
        decoded = materialize(W.read_decoded(spark, input_dir, output_dir, patterns))
        rows = W.read_rows(decoded)
        inf = infer(rows, files, aliases or COLUMN_ALIASES)
        chosen = materialize(inf.chosen)  # a row per workbook, read by every consumer
        regs = by_dataset(materialize(register_rows(rows, chosen, locale, ministry_rules)))
        # each register feeds the rollup, the link, the anti join and its own sink
        pres, rec = regs["presentados"], regs["recomendados"]
        base = materialize(consolidate.authoritative(pres, rec, sort=False, extra=("source_path",)))
        auth = base.drop("source_path")
        outputs = {
            "presentados_normalized": with_row_ids(pres, "presentado_row_id").drop("_order"),
            "recomendados_normalized": with_row_ids(rec, "recomendado_row_id").drop("_order"),
            "projects_authoritative": consolidate.sort_authoritative(auth),
            "summary_by_ministerio": reports.summary_by_group(auth, money_scale=None),
            "linkage_audit": reports.linkage_audit(auth),
            "unlinked_recommended": unlinked_recommended(pres, rec).drop("_order"),
        }
        n = sinks.publish(outputs, output_dir, fmt) if atomic else sinks.write_all(outputs, output_dir, fmt)
        ledger = deck.form_ledger(inv, W.decode_errors(decoded), chosen, pres, rec, base)
        sinks.write(ledger, f"{output_dir.rstrip('/')}/ledger", "parquet")  # it has nested columns
    if atomic:
        published = {name: sinks.read_published(spark, output_dir, name) for name in outputs}
    else:
        published = {name: sinks.read(spark, f"{output_dir.rstrip('/')}/{name}", df.schema, fmt) for name, df in outputs.items()}
    published["ledger"] = spark.read.parquet(f"{output_dir.rstrip('/')}/ledger")
    print(f"Wrote processed datasets to {output_dir}")
    print(f"Rows in authoritative set: {n.get('projects_authoritative')}")
    return published
