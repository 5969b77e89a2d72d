"""Chains of stages with checkpoints, validation and reports."""
