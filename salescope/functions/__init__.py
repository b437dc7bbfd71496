"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from .numeric import (  # noqa: F401
    as_double, decimal_text, growth, growth_rate, money, report_pct_text,
    round_half_even, round_half_up, safe_ratio, sheet_pct_text, sheet_ratio,
)
from .text import (  # noqa: F401
    id_text, iso_week, parse_date, sentinel_number, strict_number, thousands_number,
)
