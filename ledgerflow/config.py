"""Column names, conform specs and fixed values shared by all operators.

Every operator takes its column names from here (or from a caller-supplied
spec), so one generic function replaces the per-region / per-source copies a
hand-written job would carry.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

# --- Fixed values (must equal the source system's for right results) -------
# Posting classes written in the mapping sheet's "normal/correctora" column.
NORMAL = "Normal"
CORRECTING = "Correctora"
# Account ids in the mapping sheet that mean "do not post to this side".
NO_POSTING_ACCOUNTS = ("NA", "NAD", "NAC")
# Register types of the two transaction sources.
TYPE_OPERATION = "OP"
TYPE_CONCEPT = "EC"
# Countries served by the reports.
REGIONS = ("MX", "BR", "CO")
# Op code given to change-feed rows whose Op is null (initial full load).
FULL_LOAD_OP = "C"
DELETE_OP = "D"
# Timestamp text format of the report layer.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# History cut-offs used by the reprocess and history reports.
REPROCESS_CUTOFF_DATE = "2023-01-01"
HISTORY_START = "2023-01-01 00:00:00.000"
# Active client status value.
ACTIVE_STATUS = "0"
# --- end of fixed values ----------------------------------------------------

# --- Fixed values: table and column names of the data model ----------------
# The silver and gold tables the jobs write, and the source-system tables they
# read, use these names; they must match for existing tables to be read and
# merged.  Names of source columns are the defaults of the spec classes below.

# Date-part columns.
YEAR, MONTH, DAY = "year", "month", "day"
DATE_PARTS = (YEAR, MONTH, DAY)
# Partition columns of this library's own tables (not of the data model), by
# the unit of time that one folder holds.
PERIODS = {"day": "period_day", "month": "period_month"}

# Ledger (silver transactions) columns.
INSERT_DATE = "insert_date"
UUID = "uuid"
DATE = "date"
ACCOUNTING_DATE = "accounting_date"
INVOICE = "invoice"
INVOICE_DESCRIPTION = "invoice_description"
TYPE = "type"
ID_CLIENT = "id_client"
AMOUNT = "amount"
AMOUNT_D = "amount_d"
AMOUNT_C = "amount_c"
POSTING_CLASS = "normal_correctora"
ACCOUNT_ID = "account_id"
DEBIT_ACCOUNT = "debit_account"
CREDIT_ACCOUNT = "credit_account"
COUNTRY = "country"

# Conformed transaction columns before the sign split.
TRANSACTION_COLUMNS = (INSERT_DATE, UUID, DATE, ACCOUNTING_DATE, INVOICE,
                       INVOICE_DESCRIPTION, TYPE, ID_CLIENT)
SPLIT_COLUMNS = TRANSACTION_COLUMNS + (AMOUNT_D, AMOUNT_C)
LEDGER_COLUMNS = TRANSACTION_COLUMNS + (POSTING_CLASS, AMOUNT_D, AMOUNT_C,
                                        ACCOUNT_ID) + DATE_PARTS
LEDGER_KEY = (UUID, ACCOUNT_ID)
UNMAPPED_COLUMNS = (INSERT_DATE, UUID, DATE, INVOICE, INVOICE_DESCRIPTION,
                    TYPE, ID_CLIENT, AMOUNT_D, AMOUNT_C) + DATE_PARTS
UNMAPPED_KEY = (UUID,)
INVOICE_REPORT_COLUMNS = (INVOICE, TYPE, COUNTRY, POSTING_CLASS)
INVOICE_REPORT_KEY = (INVOICE, TYPE, POSTING_CLASS, COUNTRY)

# Client columns.
CREATED_AT = "created_at"
COMPANY_NAME = "company_name"
TAX_ID = "tax_id"
CLIENT_ID = "client_id"
CLIENT_COLUMNS = (CREATED_AT, COMPANY_NAME, TAX_ID, CLIENT_ID, COUNTRY)
CLIENT_KEY = (CLIENT_ID,)
# --- end of data-model names (source column names follow as spec defaults) --


@dataclass(frozen=True)
class ConceptMapSpec:
    """Column names of the concept-to-account mapping sheet."""

    code: str = "economic_concept"
    posting_class: str = "normal/correctora"
    register_type: str = "registertype"
    description: str = "ec_description_"
    debit_account: str = DEBIT_ACCOUNT
    credit_account: str = CREDIT_ACCOUNT
    year: str = YEAR
    month: str = MONTH
    day: str = DAY


@dataclass(frozen=True)
class TransactionSpec:
    """How one transaction source maps onto the conformed ledger columns.

    ``columns`` maps conformed name -> source column name for the pass-through
    columns; ``uuid_prefix`` and ``type_value`` are literals that tell the
    sources apart once they are unioned.
    """

    type_value: str
    uuid_prefix: str
    columns: Mapping[str, str]
    contract: str = "contract_id"
    amount: str = "amount"

    def source(self, name: str) -> str:
        return self.columns.get(name, name)


@dataclass(frozen=True)
class ClientSpec:
    """Column names of a per-region companies table."""

    status: str = "status"
    contract: str = "contract_id"
    created_at: str = "start_operation"
    company_name: str = "legal_name"
    tax_id: str = "tax_identify"


# Source-system layouts of the two transaction tables.  The
# contract column is named by the caller (``contract=``) when it differs.
OPERATIONS = TransactionSpec(
    type_value=TYPE_OPERATION,
    uuid_prefix="op-",
    columns={INSERT_DATE: "insert_date", UUID: "uuid", DATE: "invoice_date",
             ACCOUNTING_DATE: "accounting_operation_date", INVOICE: "invoice_type",
             INVOICE_DESCRIPTION: "invoice_type_description"},
    amount="invoice_amount",
)
CONCEPTS = TransactionSpec(
    type_value=TYPE_CONCEPT,
    uuid_prefix="ec-",
    columns={INSERT_DATE: "insert_date", UUID: "uuid",
             DATE: "interests_calculation_last_date", ACCOUNTING_DATE: "file_date",
             INVOICE: "economic_concept_code",
             INVOICE_DESCRIPTION: "economic_concept_code_description"},
    amount="economic_concept_gross_amount",
)


@dataclass(frozen=True)
class ChangeFeedSpec:
    """Change-data-capture feed layout."""

    keys: Sequence[str]
    sequence: str = "transact_seq"
    op: str = "Op"
    timestamp: str = "TIMESTAMP"
    tie_break: Sequence[str] = field(default_factory=tuple)
