"""Registered queries and the multi-step annotation flows."""
