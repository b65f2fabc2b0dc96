"""The registered queries, their test inputs and their independent SQL."""
