from tallyroll.sources.files import read_csv_header, read_csv_named, read_delimited_numbers
from tallyroll.sources.receipts import load_table, receipts, receipts_test
from tallyroll.sources.rows import inline_rows, random_columns
from tallyroll.sources.sinks import write_csv_header, write_csv_plain

__all__ = [
    "inline_rows", "load_table", "random_columns", "read_csv_header", "read_csv_named",
    "read_delimited_numbers", "receipts", "receipts_test", "write_csv_header", "write_csv_plain",
]
