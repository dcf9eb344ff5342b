from fulcrum.functions.numeric import (  # noqa: F401
    as_double,
    ratio,
    round_half_up,
    round_half_even,
    coefficient_of_variation,
)
from fulcrum.functions.measures import (  # noqa: F401
    flag_rate,
    strict_flag_rate,
    conditional_mean,
    conditional_sum,
)
