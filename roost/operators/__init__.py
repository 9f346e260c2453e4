"""The five steps, and the helpers that keep them whole under skew."""
