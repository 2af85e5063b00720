"""Distributed plan shapes shared by the operators."""
