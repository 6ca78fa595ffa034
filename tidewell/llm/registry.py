"""The text operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import bpe as _bpe
from . import decontaminate as _decontaminate
from . import langid as _langid
from . import lmscore as _lmscore
from . import neardup as _neardup
from . import ogg as _ogg
from . import pii as _pii
from . import sharding as _sharding
from . import substring as _substring
from . import toxicity as _toxicity


def queries() -> dict:
    return {
        "op1_substring": _substring.op1_substring,
        "op2_bpe": _bpe.op2_bpe,
        "op3_ogg": _ogg.op3_ogg,
        "op4_pii": _pii.op4_pii,
        "op5_langid": _langid.op5_langid,
        "op6_decontaminate": _decontaminate.op6_decontaminate,
        "op7_toxicity": _toxicity.op7_toxicity,
        "op8_lmscore": _lmscore.op8_lmscore,
        "op9_sharding": _sharding.op9_sharding,
        "op10_neardup": _neardup.op10_neardup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring": _substring.OP1_SQL,
        "op6_decontaminate": _decontaminate.OP6_SQL,
        "op9_sharding": _sharding.OP9_SQL,
        "op10_neardup": _neardup.OP10_SQL,
    }
