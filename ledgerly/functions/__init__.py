"""Column functions: pure expressions, no UDFs."""

from ledgerly.functions.codes import (
    AGENCY_CODES,
    DOC_TYPE_CODES,
    STATUS_CODES,
    entry_type,
    event_key,
    management_type,
    receipt_status,
    settlement_date,
    translate_codes,
)
from ledgerly.functions.common import column
from ledgerly.functions.ids import event_id, key_text
from ledgerly.functions.lookup import (
    UnknownColumnError,
    check_columns,
    column_equals,
    pick_column,
    posting_description,
)
from ledgerly.functions.money import money
from ledgerly.functions.provenance import file_prefix, with_ingest_time

__all__ = [
    "AGENCY_CODES", "DOC_TYPE_CODES", "STATUS_CODES", "UnknownColumnError",
    "check_columns", "column", "column_equals", "entry_type", "event_id",
    "event_key", "file_prefix", "key_text", "management_type", "money",
    "pick_column", "posting_description", "receipt_status", "settlement_date",
    "translate_codes", "with_ingest_time",
]
