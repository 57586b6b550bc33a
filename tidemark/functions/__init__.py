from tidemark.functions import numbers, text, time

__all__ = ["numbers", "text", "time"]
