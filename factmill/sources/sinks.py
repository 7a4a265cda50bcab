"""Sinks: review CSV with a fixed column order, workbooks, scorecard, run log, snapshots."""

from __future__ import annotations

import logging
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.functions.vocab import shown_multiple


def review_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """Columns in the given order; those missing are empty, others are left out."""
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def snapshot(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """A new version of a table; with a partition column only the partitions that come are replaced."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def run_log(df: DataFrame, path: str) -> bool:
    """Appends to a log; a log that can't be written is told and stops nothing."""
    try:
        df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
    except Exception:
        logging.getLogger(__name__).exception("the run log could not be written: %s", path)
        return False
    return True


def failure_log(failures: DataFrame, keys: list[str], stage: str, path: str) -> bool:
    """Appends failures (keys, reason, attempts) to a log of rows: stage, key as JSON, reason, attempts, logged_at."""
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return run_log(failures.select(F.lit(stage).alias("stage"), key.alias("key"), "reason", F.col("attempts").cast("int").alias("attempts")), path)


def scorecard(scores: DataFrame, title: str) -> str:
    """Markdown of a table of scores (one row per field), read a partition at a time."""
    head = f"# {title}\n\n| " + " | ".join(scores.columns) + " |\n|" + "---|" * len(scores.columns) + "\n"
    rows = scores.orderBy(*scores.columns[:1]).toLocalIterator()
    return head + "".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |\n" for r in rows)


SHEET_ROWS = 1_048_576
"""Rows that a worksheet can hold."""
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Review" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def _cell(value: object) -> str:
    if value is None or value == "":
        return "<c/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook(df: DataFrame, columns: list[str], path: str) -> None:
    """A workbook of one sheet: a heading and the rows, columns in the given order (missing ones empty).

    Rows stream through the driver a partition at a time; more than a sheet holds are an error.
    """
    rows = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, xml in _PARTS.items():
            book.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + xml)
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
            for n, row in enumerate(_chained(columns, rows), 1):
                if n > SHEET_ROWS:
                    raise ValueError(f"more than {SHEET_ROWS} rows for one sheet")
                sheet.write(("<row>" + "".join(map(_cell, row)) + "</row>").encode())
            sheet.write(b"</sheetData></worksheet>")


def _chained(head: list[str], rows: DataFrame):
    yield head
    yield from rows.toLocalIterator()


# Fixed value: the canonical export's columns, in order.
EXPORT = [
    "transaction_id", "deal_type", "event_type", "transaction_status", "spin_split_type", "distribution_mechanism", "target_name", "target_domain", "target_ticker", "target_type",
    "pct_acquired", "target_status", "target_description", "acquirer_name", "acquirer_domain", "acquirer_ticker", "acquirer_type", "acquirer_description", "acquirer_sponsor_name",
    "parent_seller_name", "parent_seller_ticker", "parent_seller_description", "announced_date", "signing_date", "closed_date", "value_amount", "value_currency", "value_type",
    "per_share_price", "equity_value", "implied_equity_value", "implied_enterprise_value", "implied_enterprise_value_basis", "transaction_value", "transaction_value_basis",
    "deal_value_currency", "target_revenue", "target_revenue_period_type", "target_revenue_period_end", "target_ebitda", "target_ebitda_period_type", "target_ebitda_period_end",
    "ev_to_revenue_ltm", "ev_to_revenue_ntm", "ev_to_ebitda_ltm", "ev_to_ebitda_ntm", "multiple_quality", "consideration_type", "consideration_components_json", "includes_earnout",
    "hostile", "competing_bid", "regulatory_approvals_required", "has_go_shop", "go_shop_period_days", "target_fee_amount", "target_fee_percentage", "acquirer_fee_amount",
    "acquirer_fee_percentage", "is_take_private", "is_add_on", "is_divestiture", "is_de_spac", "has_earnout", "has_cvr", "linked_filings_count", "acquirer_merger_sub_name",
    "merger_structure", "has_mac_clause", "requires_target_shareholder_vote", "target_vote_threshold", "target_total_diluted_shares", "fully_diluted_calc_quality",
    "agreement_extraction_status", "linked_securities_count", "has_observation_changes", "observation_changes_field_count", "summary_text", "primary_rationale",
    "secondary_rationales_json", "target_financial_advisors", "target_legal_advisors", "acquirer_financial_advisors", "acquirer_legal_advisors", "parent_seller_financial_advisors",
    "parent_seller_legal_advisors", "both_advisors", "other_advisors", "unknown_advisors", "advisors_json", "source_urls", "source_titles", "source_categories", "source_party_1_names",
    "source_party_1_domains", "source_party_2_names", "source_party_2_domains", "source_metadata_json", "created_at", "updated_at",
]


def export_csv(df: DataFrame, path: str) -> None:
    """The canonical export: its columns in their order, multiples as they are shown."""
    shown = [c for c in df.columns if c.startswith("ev_to_")]
    quality = F.col("multiple_quality") if "multiple_quality" in df.columns else F.lit(None).cast("string")
    review_csv(df.withColumns({c: shown_multiple(F.col(c), quality) for c in shown}), EXPORT, path)
