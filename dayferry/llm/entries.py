"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from dayferry.llm.chat import OP9_SQL, op9_chat_windows
from dayferry.llm.cover_tree import OP11_SQL, op11_cover_tree_links
from dayferry.llm.ctw import op5_context_tree_score
from dayferry.llm.infill import OP12_SQL, op12_counted_infill
from dayferry.llm.jaccard import op6_chosen_path_join
from dayferry.llm.mixing import op4_entropy_mixing
from dayferry.llm.multi_index import op3_multi_index_search
from dayferry.llm.packing import op1_window_packing
from dayferry.llm.quality import op2_llr_quality
from dayferry.llm.rans import op7_rans_tokens
from dayferry.llm.resampling import OP13_SQL, op13_segment_resampling
from dayferry.llm.toxicity import op10_kneser_ney_toxicity
from dayferry.llm.warc import OP8_SQL, op8_seekable_warc
from dayferry.llm.workers import reaching_workers

QUERIES: dict[str, Callable] = {
    f.__name__: reaching_workers(f)
    for f in (
        op1_window_packing,
        op2_llr_quality,
        op3_multi_index_search,
        op4_entropy_mixing,
        op5_context_tree_score,
        op6_chosen_path_join,
        op7_rans_tokens,
        op8_seekable_warc,
        op9_chat_windows,
        op10_kneser_ney_toxicity,
        op11_cover_tree_links,
        op12_counted_infill,
        op13_segment_resampling,
    )
}

ORACLES: dict[str, str] = {
    "op8_seekable_warc": OP8_SQL,
    "op9_chat_windows": OP9_SQL,
    "op11_cover_tree_links": OP11_SQL,
    "op12_counted_infill": OP12_SQL,
    "op13_segment_resampling": OP13_SQL,
}
