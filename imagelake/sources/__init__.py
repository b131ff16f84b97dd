"""Readers: picture catalogues and decoding, request messages, landed pictures, the prediction log."""
