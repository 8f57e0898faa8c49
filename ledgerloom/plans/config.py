"""Codes and settings of the document pipelines.

Tenant-specific values (own companies, journal ids, vendor codes, dates) are parameters of the
config objects; the fixed values below must be exactly these for the books to match.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, functions as F

# ---- Fixed values -------------------------------------------------------------------------------
UNIDENTIFIED = "Unidentified"

WAREHOUSE_LOCATION = {
    "ANA": "156-USA-CA", "BE-ANA": "156-USA-CA", "BRE": "156-USA-CA",
    "CRA": "156-3PL-CB", "FLO": "156-3PL-FR", "FON": "156-3PL-FT", "CQM": "156-3PL-CA",
}
SHIP_CITY_LOCATION = {  # in order of precedence
    "Fontana": "156-3PL-FT", "Cranbury": "156-3PL-CB",
    "Anaheim": "156-USA-CA", "Brea": "156-USA-CA", "FLORENCE": "156-3PL-FR",
}
REGION = {
    "USA": "REG-USA", "MEX": "REG-MXN", "CAN": "REG-CAN", "ARE": "REG-UAE", "GBR": "REG-GBR",
    "JPN": "REG-JPN", "ESP": "REG-ESP", "FRA": "REG-FRA", "DEU": "REG-DEU", "ITA": "REG-ITA",
    "SWE": "REG-SWE", "NLD": "REG-NED", "POL": "REG-POL", "TUR": "REG-TUR", "BEG": "REG-BEG",
}
IMPORT_REGION = {
    "USA": "REG-USA", "SGP": "REG-SGP", "ARE": "REG-UAE", "AUS": "REG-AUS", "CAN": "REG-CAN",
    "DEU": "REG-DEU", "GBR": "REG-GBR", "JPN": "REG-JPN", "MEX": "REG-MXN", "ITA": "REG-ITA",
    "ESP": "REG-ESP", "FRA": "REG-FRA", "SAU": "REG-SAU",
}
FULFILMENT_LOCATION = {
    "USA": "157-FA-USA", "MEX": "157-FA-MXN", "CAN": "157-FA-CAN", "ARE": "157-FA-UAE",
    "GBR": "157-FA-UK", "JPN": "157-FA-JPN", "ESP": "157-FA-FRA", "FRA": "157-FA-FRA",
    "DEU": "157-FA-FRA", "ITA": "157-FA-FRA", "SWE": "157-FA-FRA", "NLD": "157-FA-FRA",
    "POL": "157-FA-FRA", "TUR": "157-FA-FRA", "BEG": "157-FA-BEG",
}
IMPORT_LOCATION = {
    "USA": "157-DI-USA", "SGP": "157-DI-SGP", "ARE": "157-DI-UAE", "AUS": "157-DI-AUS",
    "CAN": "157-DI-CAN", "DEU": "157-DI-DEU", "GBR": "157-DI-GBR", "JPN": "157-DI-JPN",
    "MEX": "157-DI-MXN", "ITA": "157-DI-ITA", "ESP": "157-DI-ESP", "FRA": "157-DI-FRA",
    "SAU": "157-DI-SAU",
}
ACCRUAL_REGION = {"ARE": "UAE", "MEX": "MXN"}
OBH_STOCK_LOCATION = "156-OBH-CA"
OBH_IMPORT_LOCATION = "157-OBH"
CAN_3PL_LOCATION = "156-3PL-CA"

OBH_ACCOUNT = "33890101"
EXTRA_INVOICE_ACCOUNT = "71190101"
NO_UOM_ACCOUNTS = ("33890101", "71190101", "52120101")
ACCRUED_ACCOUNT = "33510102"
ACCRUED_NAME = "Accrued expenses_Short-term_Operation expenses"
PROMOTION_ACCOUNT = "64160102"
PROMOTION_NAME = "Selling exp_Promotion"
MARKETING_ACCOUNT = "64160103"
MARKETING_NAME = "Selling exp_Marketing"
DAMAGE_ACCOUNT = "64160110"
DAMAGE_OBH_ACCOUNT = "13890101"
POSTING_GROUP = "1311-MER"
OWNER_VENDOR = {
    "Bluestars": "US-MER0002-BLS", "Bitis": "US-SER0002-BTT",
    "A&D": "331US-SER0019-A&D", "HMD": "US-SER0003-HUR",
}
CUSTOMER_AMZ = "131US-MER0001-AMZ"
CUSTOMER_WF = "131US-MER0001-WF"
CUSTOMER_WM = "131US-MER0002-WM"
NO_STOCK_OWNERS = ("HMD", "MOONKEY")          # owners without a stock location
SPLIT_OWNER = "HMD"                           # owner whose on-behalf goods have no stock movement
STOCK_OWNERS = ("Bluestars", "Bitis")         # on-behalf owners whose goods move priced stock
# accrual estimate rates
COOP_MARKETING_RATE = "0.09"
FREIGHT_RATE_UNTIL = (date(2023, 3, 31), "0.117", "0.122")
IMPORT_DAMAGE_RATE = ("0.02", ("REG-DEU", "REG-GBR", "REG-ITA", "REG-FRA", "REG-ESP"))
JPN_SERVICE_RATE = ("0.08", ("REG-JPN",))
IMPORT_SERVICE_RATE = ("0.03", ("REG-DEU", "REG-GBR", "REG-AUS"))
IMPORT_COOP_RATE = ("0.02", ("REG-DEU", "REG-GBR", "REG-ITA", "REG-FRA", "REG-ESP", "REG-MXN"))
DROPSHIP_DAMAGE_RATE = "0.04"
STOCK_DAMAGE_RATE = "0.0375"
FURNITURE_SERVICE_RATE = "0.013"
ESTIMATE_CHANNELS = ("AVC DS", "AVC WH", "AVC DI", "AVC GPE", "WF", "WF CG")
ESTIMATE_REGIONS = ("REG-DEU", "REG-GBR", "REG-JPN", "REG-USA", "REG-ITA", "REG-FRA", "REG-ESP",
                    "REG-MXN", "REG-AUS", "REG-CAN")
RETURN_REGIONS = ("DEU", "JPN", "GBR", "ITA", "FRA", "ESP", "MXN", "AUS", "CAN")
# -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ChannelConfig:
    """What differs between the sales-invoice channels once their candidates are built."""

    channels: Sequence[str]                       # internal channel names of this pipeline
    own: Sequence[str]                            # companies booked as own goods
    date_from: date
    main: str | None = None                       # main company, for the mixed-owner rule
    posted_types: Sequence[str] = ("ORDER",)      # document types that count as already posted
    posted_scope: Mapping[str, Sequence[str]] = field(default_factory=dict)
    posted_key: str = "external_doc_no"
    use_excluded: bool = True
    po_exclusion: bool = False
    description_by_order_date: bool = False       # else stamped with the run date
    obh_posting_by_rule: bool = False             # else posted on the run date
    obh_location: Callable[[], Column] | None = None
    obh_stock: Callable[[], Column] | None = None  # which on-behalf rows also move stock
    obh_zero_price: bool = True
    evidence: str | None = None                   # transaction name used to find the warehouse
    evidence_key: str = "original_external_doc_no"
    dedupe_owners: bool = False
    legacy_month_number: bool = False


# ---- ready settings of the six channels: own companies and the first date are the tenant's --------
def _not_split(value: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.when(F.col("belong_to_company") != SPLIT_OWNER, value())


def _moves_stock() -> Column:
    return F.col("belong_to_company") != SPLIT_OWNER


def settlement_channel(own: Sequence[str], since: date) -> ChannelConfig:
    """Settled marketplace orders: purchase orders shipped elsewhere are left out."""
    return ChannelConfig(channels=["WM WFS"], own=own, date_from=since, po_exclusion=True, evidence="WM MKP", evidence_key="po_number")


def dropship_channel(own: Sequence[str], since: date) -> ChannelConfig:
    return ChannelConfig(channels=["WM DSV"], own=own, date_from=since, evidence="WM DSV", evidence_key="po_number")


def basecost_channel(own: Sequence[str], since: date) -> ChannelConfig:
    """Base-cost invoices: posted rows count within the two channels, on-behalf stock keeps its price."""
    return ChannelConfig(
        channels=["WF", "WF CG"], own=own, date_from=since, posted_scope={"internal_sales_channel": ["WF", "WF CG"]},
        description_by_order_date=True, obh_posting_by_rule=True, evidence="WF DS", obh_location=_not_split(lambda: F.col("wh_location")),
        obh_stock=lambda: F.col("belong_to_company").isin(*STOCK_OWNERS), obh_zero_price=False)


def direct_fulfil_channel(own: Sequence[str], since: date, main: str) -> ChannelConfig:
    """Direct fulfilment: posted by original number, no manual list, secondary owners' headers removed."""
    return ChannelConfig(
        channels=["AVC DS"], own=own, main=main, date_from=since, posted_scope={"internal_sales_channel": ["AVC DS"]},
        posted_key="original_external_doc_no", use_excluded=False, description_by_order_date=True, obh_posting_by_rule=True,
        evidence="AVC DS", obh_location=_not_split(lambda: F.lit(OBH_STOCK_LOCATION)), obh_stock=_moves_stock, dedupe_owners=True)


def payment_channel(own: Sequence[str], since: date) -> ChannelConfig:
    return ChannelConfig(channels=["ASC FBM", "ASC FBA"], own=own, date_from=since, posted_scope={"sales_channel": ["CHAN-ASC"]},
                         evidence="ASC FBM", obh_stock=_moves_stock)


def vendor_channel(own: Sequence[str], since: date) -> ChannelConfig:
    """Vendor invoices: accruals count as posted too."""
    return ChannelConfig(
        channels=["AVC DI", "AVC WH", "AVC GPE", UNIDENTIFIED], own=own, date_from=since, posted_types=("ORDER", "ACCRUAL"),
        obh_location=_not_split(lambda: F.lit(OBH_STOCK_LOCATION)), obh_stock=_moves_stock)


@dataclass(frozen=True)
class GlConfig:
    """Tenant values of general-ledger lines."""

    company_id: str | None = None
    journal_id: str | None = None
    obh_journal_id: str | None = None
    original_company_id: str | None = None
    batch_name: str | None = None
