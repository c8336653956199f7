"""Transactional-outbox delivery as Spark jobs: shape, plan, resolve, acknowledge, reconcile, report."""
