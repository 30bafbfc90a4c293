from domus.functions.columns import (absolute_error, all_true, month_index, month_period, not_nan,  # noqa: F401
                                     portable_hash, ratio)
