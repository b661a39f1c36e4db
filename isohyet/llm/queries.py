"""The registered corpus queries and their SQL."""

from . import oracles
from .decontamination import op5_decontamination
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .language_id import op9_language_id
from .mixing import op1_mixing
from .near_dedup import op2_near_dedup
from .personal_data import op11_personal_data
from .resampling import op13_resampling
from .secrets import op6_secrets
from .spelling import op12_spelling
from .substring_dedup import op8_substring_dedup
from .suffix_dedup import op7_suffix_array
from .url_filter import op10_url_filter
from .warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_near_dedup": op2_near_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_suffix_array": op7_suffix_array,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "op11_personal_data": op11_personal_data,
    "op12_spelling": op12_spelling,
    "op13_resampling": op13_resampling,
}

ORACLES = {
    "op2_near_dedup": oracles.OP2,
    "op3_exact_dedup": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op5_decontamination": oracles.OP5,
    "op7_suffix_array": oracles.OP7,
    "op8_substring_dedup": oracles.OP8,
    "op12_spelling": oracles.OP12,
    "op13_resampling": oracles.OP13,
}
