"""Readers for the report's inputs and the file sink of the photo export."""
