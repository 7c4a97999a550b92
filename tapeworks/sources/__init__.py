"""Reading frames, subscriptions and subjects; writing envelopes."""
