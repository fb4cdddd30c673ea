"""Operators that prepare documents as training data; nothing else in the library imports this subpackage."""
