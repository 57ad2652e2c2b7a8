"""Column functions. Every function returns a native Spark Column expression
(built-ins and higher-order functions), so nothing here runs in Python."""

from .match import (inverse_levenshtein, levenshtein_scores, min_levenshtein, token_text, word_match,
                    word_match_bag, word_match_text)
from .text import split_space, term_length, tokenize, remove_stop_words
from .vectors import cosine, euclidean

__all__ = ["word_match", "word_match_bag", "word_match_text", "token_text", "min_levenshtein", "inverse_levenshtein",
           "levenshtein_scores",
           "split_space", "term_length", "tokenize", "remove_stop_words", "cosine", "euclidean"]
