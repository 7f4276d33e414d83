"""Larger compositions: the batch run, dashboard scopes, evidence, query catalog."""
