"""ladewerk: shipment-confirmation data work as Spark DataFrame jobs."""
