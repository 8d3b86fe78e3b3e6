from flurry.functions.scalar import (contains_all, duration_micros, enumerate_map, epoch_micros,
                                    epoch_ms_to_ts, int_string, merge_maps, new_uuid, now_ms,
                                    quantize, subsecond_nanos, truncate, vector_element)
from flurry.functions.structs import cast_like, flatten, map_lookup, round_all
from flurry.functions.urls import path_part_from_end, resolve_url, target_file_name, url_host
from flurry.functions.vectors import caffe_preprocess, flatten_tensor, sq_norm, squared_l2

__all__ = [
    "contains_all", "duration_micros", "enumerate_map", "epoch_micros", "epoch_ms_to_ts",
    "int_string", "merge_maps", "new_uuid", "now_ms", "quantize", "subsecond_nanos",
    "truncate", "vector_element", "cast_like", "flatten", "map_lookup", "round_all",
    "path_part_from_end", "resolve_url", "target_file_name", "url_host",
    "caffe_preprocess", "flatten_tensor", "sq_norm", "squared_l2",
]
