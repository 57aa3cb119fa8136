"""Partner report contracts (IO6-IO9, IO11, F32): required columns, renames, header trimming, lenient typing.

Reports arrive as CSV or Parquet (spreadsheets are exported first; xlsx decoding is a single-machine codec and is not
built). Reading is `spark.read` with every cell as text; typing is `try_cast`, so an unparsable number or date becomes
null instead of failing the job (ANSI casts raise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.formats import DATE_PATTERNS, read_dates

# The distributor report's spreadsheet headers and their canonical names, in report order.
DISTRIBUTOR_COLUMNS = {
    "Date of Sale": "date_of_sale",
    "Original Date of Sale": "original_date_of_sale",
    "Date Fulfilled": "date_fulfilled",
    "Transaction GUID": "transaction_guid",
    "CTID": "ctid_1",
    "Publisher Name": "publisher_name",
    "Product Title": "product_title",
    "SKU": "sku",
    "Genba Product ID": "genba_product_id",
    "Country Sold": "country_sold",
    "Activation Qty": "activation_qty",
    "Activation Currency": "activation_currency",
    "SRP Activation Currency": "srp_activation_currency",
    "Promotion %": "promotion_%",
    "WSP Activation Currency": "wsp_activation_currency",
    "Service Charge Activation Currency": "service_charge_activation_currency",
    "Exchange Rate": "exchange_rate",
    "Billing Currency": "billing_currency",
    "WSP Billing Currency": "wsp_billing_currency",
    "WSP VAT": "wsp_vat",
    "Service Charge Billing Currency": "service_charge_billing_currency",
    "Service Charge VAT": "service_charge_vat",
    "Grand Total": "grand_total",
}
# Which of them are dates and which are numbers.
DISTRIBUTOR_DATES = ("date_of_sale", "original_date_of_sale", "date_fulfilled")
DISTRIBUTOR_NUMERICS = (
    "activation_qty", "srp_activation_currency", "wsp_activation_currency", "service_charge_activation_currency",
    "exchange_rate", "wsp_billing_currency", "wsp_vat", "service_charge_billing_currency", "service_charge_vat",
    "grand_total",
)
NUMERIC_TYPE = "decimal(24,6)"


class MissingColumnsError(ValueError):
    pass


def trim_headers(df: DataFrame) -> DataFrame:
    """IO8: strip spaces around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, required) -> DataFrame:
    """IO7: raise with the missing names, in contract order."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"report missing columns: {missing}")
    return df


def lenient_date(column: str, patterns=DATE_PATTERNS) -> Column:
    """One text cell as a date, whatever its column holds: ISO dates and times first, then each pattern; null if none fits.
    For a column whose cells share a format use formats.read_dates."""
    text = F.trim(F.col(column).cast("string"))
    return F.coalesce(text.try_cast("timestamp").cast("date"),
                      *[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])


def apply_contract(df: DataFrame, colmap: dict[str, str], dates=(), numerics=(), numeric_type: str = NUMERIC_TYPE,
                   date_patterns=DATE_PATTERNS, by: str | None = None, undecided: str = "first") -> DataFrame:
    """IO7 + IO9: check, rename, then type dates and numbers leniently (what cannot be typed is null; formats.lost_cells
    counts it). The order of day and month is decided per column from all of its cells, and per file if the column `by` names
    it, which runs one counting job over the report (see formats); `undecided` says what happens if no cell decides."""
    df = require_columns(df, list(colmap)).withColumnsRenamed(colmap)
    df = read_dates(df, dates, date_patterns, by, undecided)
    return df.withColumns({c: F.col(c).cast("string").try_cast(numeric_type) for c in numerics})


def read_distributor_report(df: DataFrame, date_patterns=DATE_PATTERNS, by: str | None = None, undecided: str = "first") -> DataFrame:
    return apply_contract(df, DISTRIBUTOR_COLUMNS, DISTRIBUTOR_DATES, DISTRIBUTOR_NUMERICS, date_patterns=date_patterns, by=by,
                          undecided=undecided)


def read_report_files(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO6: read a partner report as text cells; a missing path raises PATH_NOT_FOUND (IO11)."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    return spark.read.format(fmt).load(path)
