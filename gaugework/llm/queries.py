"""All queries of the training-data operators; importing this module registers them."""

from . import bag_minhash, bpe_lookup, chained_passages, content_sort, feistel_pii, fill_middle, language, license_model, lyndon_runs, packing, pivot_index, projection_forest, secret_forest  # noqa: F401
from .common import ORACLES, QUERIES  # noqa: F401
