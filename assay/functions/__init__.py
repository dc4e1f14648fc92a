from assay.functions.casts import lenient_date, lenient_double, lenient_int
from assay.functions.exact import exact_totals
from assay.functions.money import exact_mean, exact_sum
from assay.functions.picks import hash_pick

__all__ = ["exact_mean", "exact_sum", "exact_totals", "hash_pick", "lenient_date", "lenient_double", "lenient_int"]
