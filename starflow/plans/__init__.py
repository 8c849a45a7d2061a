"""Compositions: staging (C1-C8), dimensions (C9-C11), fact (C12), load (C13, K*), pipeline."""
