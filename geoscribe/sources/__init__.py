from geoscribe.sources.delimited import (parse_fields, reject_reason, scan_delimited, scan_query_lines,
                                         scan_with_rejects, scan_word_list, stage_delimited)
from geoscribe.sources.tables import table

__all__ = ["parse_fields", "reject_reason", "scan_delimited", "scan_query_lines", "scan_with_rejects", "scan_word_list",
           "stage_delimited", "table"]
