"""Column layouts of the document tables. Writes are by name, so order carries no meaning."""

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

_S, _D, _B, _T, _I, _L = StringType(), DateType(), BooleanType(), TimestampType(), IntegerType(), LongType()
# Compact decimals (8 bytes, hashed and compared as integers) hold 16 digits before the cents;
# a larger value raises instead of being cut.
_MONEY, _NUM = DecimalType(18, 2), DecimalType(18, 6)


def _struct(*groups) -> StructType:
    return StructType([StructField(name, dtype) for dtype, names in groups for name in names.split()])


SNAPSHOT = _struct(
    (_D, "order_date posting_date document_date"),
    (_S, "document_type bill_to_customer sell_to_customer platform customer_posting_group posting_description "
         "payment_term external_doc_no wh_location currency source_code sales_channel country"),
    (_L, "line_no"), (_S, "type no description uom"), (_NUM, "unit_price line_discount_pct discount quantity"),
    (_S, "vat_product_posting_group"), (_MONEY, "amount"), (_NUM, "vat_amount"), (_S, "batch_seq po_number"),
    (_B, "is_valid_record"), (_T, "data_updated_time"),
    (_S, "internal_sales_channel original_external_doc_no asin company_id original_company_id belong_to_company"),
)

HEADER = _struct(
    (_D, "order_date posting_date document_date"),
    (_S, "document_type bill_to_customer sell_to_customer platform customer_posting_group posting_description "
         "payment_term_code external_doc_no location currency source_code sales_channel country"),
    (_B, "is_valid_record"), (_T, "data_updated_time"),
    (_S, "internal_sales_channel original_external_doc_no company_id original_company_id belong_to_company name"),
    (_I, "is_processed"),
)

LINE = _struct(
    (_S, "document_no"), (_L, "line_no"), (_S, "type no description uom"), (_MONEY, "unit_price"),
    (_NUM, "line_discount_pct discount quantity"), (_S, "location_code vat_product_posting_group"),
    (_MONEY, "amount"), (_NUM, "vat_amount"), (_S, "country sales_channel platform batch_seq po_number"),
    (_T, "data_updated_time"), (_S, "original_asin_sku"),
)

GL_LINE = _struct(
    (_D, "posting_date"), (_S, "due_date document_type document_no bal_vat_bus_posting_group vat_prod_posting_group "
                              "account_type account_no account_name posting_group descriptions gen_prod_posting_group"),
    (_MONEY, "amount"), (_S, "bal_account_type bal_account_no bal_vat_prod_posting_group bal_gen_prod_posting_group "
                            "currency_code channel_code region_code platform_code external_document_no "
                            "company_ic_code"),
    (_T, "data_updated_time"), (_S, "original_invoice_company"), (_D, "document_date"), (_S, "exporting_time"),
    (_I, "is_processed"), (_S, "error_type company_id journal_id original_company_id accounts batch_name other_name"),
)

ESTIMATE = _struct(
    (_D, "posting_date"), (_S, "sales_channel internal_sales_channel platform invoice_number po_number country "
                              "currency company original_company_id"),
    (_D, "document_date"), (_S, "sku"), (_NUM, "unit_price quantity"), (_MONEY, "amount"), (_I, "is_processed"),
    (DecimalType(6, 4), "rate"), (DecimalType(18, 6), "accrual_amt"), (_S, "original_invoice note type"),
)


def conform(df, schema: StructType):
    """Select the columns of a layout by name and cast them; missing columns become typed nulls."""
    present = {f.name: f.dataType for f in df.schema.fields}
    texts = []
    for f in schema.fields:
        if present.get(f.name) == f.dataType:
            texts.append(f"`{f.name}`")
        else:
            source = f"`{f.name}`" if f.name in present else "null"
            texts.append(f"cast({source} as {f.dataType.simpleString()}) as `{f.name}`")
    return df.selectExpr(*texts)
