"""Column-level helpers (return ``Column``; no DataFrame work)."""

from seqwise.functions.semantics import (  # noqa: F401
    eq_flag, na_cumsum, na_sum, nan_to_null, ne_keep_null, not_in, order_key,
    r_ifelse, safe_ratio,
)
from seqwise.functions.scalar import (  # noqa: F401
    argmax, attempt_rule, closed_flag, encode_by_list, label_of, mmss_to_seconds, recode, signed_by_side,
    step_mask,
)
