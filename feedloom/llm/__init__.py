"""Operators for preparing training data: each module has one operator, its query and, where SQL can express it, its oracle."""
