from .writers import write_corpus, write_page_dict, write_per_document, write_result_csv

__all__ = ["write_corpus", "write_page_dict", "write_per_document", "write_result_csv"]
