"""The stages of an analytics project, one module each."""
