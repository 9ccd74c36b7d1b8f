"""Streaming forms of the batch operators. Each ends in the table its batch form gives."""
