from flurry.streaming.monitor import (as_event_time, instant_micros, replay, stream_session, run_to_parquet, start_count_batches,
                                      stream_attach_truth, stream_score, stream_window_accuracy)

__all__ = ["as_event_time", "instant_micros", "stream_session", "replay", "run_to_parquet", "start_count_batches", "stream_attach_truth",
           "stream_score", "stream_window_accuracy"]
