"""Column-expression helpers; every helper returns a Spark ``Column``."""

from hearth.functions.codec import (  # noqa: F401
    decode_model_list, decode_pairs, dict_assign, encode_keys, encode_pairs,
    first_model, malformed_pairs, split_entries,
)
from hearth.functions.images import (  # noqa: F401
    b64, data_uri, data_uri_bytes, resize_thumb, sniff_type, tidy_url,
)
from hearth.functions.text import (  # noqa: F401
    first_match, part, py_float_str, py_strip, required_match, split_parts,
    strict_double, title_clean,
)
