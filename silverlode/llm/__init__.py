"""Training-data operators: language, privacy, tokens, search, licences, leaks, quality, copies."""
