from tidemark.functions.money import money, to_amount
from tidemark.functions.text import NULL_TOKENS, map_null_tokens, null_if_token, standard_text

__all__ = ["NULL_TOKENS", "map_null_tokens", "money", "null_if_token", "standard_text", "to_amount"]
