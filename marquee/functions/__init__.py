from marquee.functions.vocab import GENRE_VOCAB, NO_GENRES, genre_vocab_col
from marquee.functions import vectors, text

__all__ = ["GENRE_VOCAB", "NO_GENRES", "genre_vocab_col", "vectors", "text"]
