"""Queries of this subpackage, by name, and their DuckDB SQL where it exists."""
from tradewind.llm.alignment import op13_alignment
from tradewind.llm.bpe import op8_byte_bpe
from tradewind.llm.chat import op7_chat
from tradewind.llm.fingerprint import op2_fingerprint
from tradewind.llm.langid import op4_language_id
from tradewind.llm.ngram_join import op3_ngram_jaccard
from tradewind.llm.packing import op9_packing
from tradewind.llm.periodic import op11_periodic_runs
from tradewind.llm.sharding import op1_sharding
from tradewind.llm.topk import OP5_SQL, op5_topk
from tradewind.llm.toxicity import op10_toxicity
from tradewind.llm.url_filter import OP12_SQL, op12_url_filter
from tradewind.llm.warc import OP6_SQL, op6_warc_revisits

LLM_QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_fingerprint, op3_ngram_jaccard, op4_language_id, op5_topk,
    op6_warc_revisits, op7_chat, op8_byte_bpe, op9_packing, op10_toxicity,
    op11_periodic_runs, op12_url_filter, op13_alignment)}

LLM_ORACLE_SQL = {"op5_topk": OP5_SQL, "op6_warc_revisits": OP6_SQL, "op12_url_filter": OP12_SQL}
