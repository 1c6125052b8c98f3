from prospectra.streaming.score_stream import read_request_stream, score_stream

__all__ = ["read_request_stream", "score_stream"]
