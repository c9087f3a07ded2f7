from runstar.functions.text import (address_query, blank_to_null, first_or_null, json_text, pipe_join,
                                    run_prefix, text_length)

__all__ = ["address_query", "blank_to_null", "first_or_null", "json_text", "pipe_join", "run_prefix", "text_length"]
