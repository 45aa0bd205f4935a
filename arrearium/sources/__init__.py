"""Bronze readers and writers, entity specs, bronze -> silver, run bookkeeping."""
