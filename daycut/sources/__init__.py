"""Inputs: landing envelopes, declared schemas and the calendar dimension."""
