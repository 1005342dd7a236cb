"""Structured Streaming recommender."""

from recspark.streaming.recommender import (  # noqa: F401
    StreamRecommender, recent_state_update, kafka_rating_events, file_rating_events,
)
