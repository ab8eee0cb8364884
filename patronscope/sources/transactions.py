"""Reading the raw invoice-line table and bringing it to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

RAW_SCHEMA = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
])

# Column spellings met in the wild and the canonical name of each.
COLUMN_NAMES = {
    "Invoice": "invoice", "InvoiceNo": "invoice", "StockCode": "stock_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "Price": "unit_price", "UnitPrice": "unit_price",
    "Customer ID": "customer_id", "CustomerID": "customer_id", "Customer Id": "customer_id",
    "Customer_ID": "customer_id", "Country": "country", "TotalAmount": "total_amount",
    "Total_Amount": "total_amount", "Recency": "recency", "Frequency": "frequency", "Monetary": "monetary",
    "R_Score": "r_score", "F_Score": "f_score", "M_Score": "m_score", "RFM_Score": "rfm_score",
    "RFM_Segment": "rfm_segment_code", "Segment": "segment", "Churn_Probability": "churn_probability",
    "CLV_Estimate": "clv_estimate",
}


#: Text survives a round trip: blanks at the ends are kept and quotes doubled. Line breaks inside a field need ``multiLine``,
#: which makes files unsplittable, so it is the caller's choice.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: On reading, an empty field is NULL and a quoted empty one an empty text; that needs a null mark which no text has.
CSV_READ = {**CSV_OPTIONS, "nullValue": "\0"}


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Invoice lines with declared types; identifiers stay text, so leading zeros and 'C' prefixes survive."""
    reader = spark.read.schema(RAW_SCHEMA)
    return reader.options(**CSV_READ).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def conform_columns(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Rename every known spelling to the canonical name; unknown columns pass through."""
    names = {**COLUMN_NAMES, **(extra or {})}
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})


def parse_timestamp(text: Column) -> Column:
    """Timestamp from ISO text; anything unreadable becomes NULL."""
    return F.try_to_timestamp(F.substring(text, 1, 19)).cast("timestamp_ntz")


def normalise_dates(df: DataFrame, column: str = "invoice_date", required: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """Typed timestamp plus its ISO text form; rows without a date or a required id are dropped."""
    typed = df.schema[column].dataType
    value = parse_timestamp(F.col(column)) if isinstance(typed, T.StringType) else F.col(column).cast("timestamp_ntz")
    return (
        df.withColumn(column, value)
        .withColumn(f"{column}_text", F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
        .dropna(subset=[column, *required])
    )
