"""Queries of this subpackage, by name."""

from gristmill.llm.bpe import op8_bpe
from gristmill.llm.chroma import op7_chroma
from gristmill.llm.ctw import op9_ctw
from gristmill.llm.langid import op2_langid
from gristmill.llm.nndescent import op10_nndescent
from gristmill.llm.packing import op5_packing
from gristmill.llm.quality import op3_quality
from gristmill.llm.simhash import op4_simhash
from gristmill.llm.suffix import op6_suffix
from gristmill.llm.urlfilter import op1_urlfilter

QUERIES = {
    "op7_chroma": op7_chroma,
    "op3_quality": op3_quality,
    "op1_urlfilter": op1_urlfilter,
    "op10_nndescent": op10_nndescent,
    "op5_packing": op5_packing,
    "op6_suffix": op6_suffix,
    "op9_ctw": op9_ctw,
    "op2_langid": op2_langid,
    "op4_simhash": op4_simhash,
    "op8_bpe": op8_bpe,
}
ORACLES: dict[str, str] = {}
