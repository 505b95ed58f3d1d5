"""The registered queries of the training-data operators."""

from importlib import import_module

MODULES = {
    "op1_chat": "chat", "op2_suffix": "suffix", "op3_warc": "warc", "op4_mixing": "mixing", "op5_html": "html", "op6_minhash": "minhash",
    "op7_quality": "quality", "op8_embeddings": "covertree", "op9_bpe": "bpe", "op10_paragraphs": "paragraphs",
    "op11_wavelet": "wavelet", "op12_trie": "trie", "op13_phrases": "phrases",
}


def llm_queries() -> dict:
    from corpus_pipeline import run
    return {name: import_module(f"surveil.llm.{module}").query for name, module in MODULES.items()} | {"pipeline": run}
